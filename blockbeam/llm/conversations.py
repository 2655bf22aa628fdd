"""Conversation structure repair: the cheapest edits that give every conversation the role pattern
``(s?(ua)+)?`` (an optional system turn, then user and assistant in turns).

Faults. Each row has at most one: *blank* (no visible character), *duplicate* (same role and text earlier in
the conversation), *truncated* (the last visible character isn't ``.``, ``!`` or ``?``), tested in this order.

Edits. Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (an empty user or assistant turn, anywhere) 2.
Blank and duplicate rows must be deleted; a truncated row that stays adds 1. Of the cheapest edit
sequences the one whose initials (D, I, K, R) sort first in ASCII is taken.

Method: a run-length dynamic program. Equal consecutive (role initial, fault) symbols collapse into runs. A
symbol is a min-plus matrix over the pattern's four states, and a run of k rows is its k-th power, applied through
powers of two that are computed once for each symbol and kept. Going through the runs from the last to the first
gives the cost still to come at each run's border; going forward, each run is unrolled row by row against
the cost to come, and the first of D, I, K, R that lies on a cheapest way is taken.

On Spark: faults come from aggregates over (conversation, role, digest of the text). A first pass over these narrow
rows (no texts), sorted by conversation and turn, streams each conversation's symbols and holds only its runs.
A second pass streams the texts, sorted alike, behind their conversation's edits, and hashes the repaired
lines as they come. Memory doesn't grow with texts; a conversation's rows pass one task in order, because its
digest is one SHA-256 and its audit one string.

Defined results: a null role or text is one space, a null in the key of the damage too. Rows are ordered by turn (nulls
first), then by role and the text's digest, so ties don't depend on partitions; repeated rows are duplicates.
A null conv_id is a conversation of its own. A conversation without rows after the damage gives zeros, an empty audit and
the digest of an empty string. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANKS, column, prepare, slices, stage

INF = 1 << 60
#: States of the pattern: nothing yet, after s, after u, after a. NEXT: the state after the one of u and a that may follow.
STATES = range(4)
NEXT, WANTED, DONE = (2, 2, 3, 2), "uuau", (True, False, False, True)
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(tuple(min(x + b[m][j] for m, x in enumerate(row)) for j in STATES) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + v[m] for m, x in enumerate(row)) for row in a)


def kept(role: str, state: int) -> int | None:
    """The state after a row that keeps its role, if the pattern allows it here."""
    if role == "s" and state == 0:
        return 1
    return NEXT[state] if role == WANTED[state] else None


#: Cost of going from a state to another by insertions alone (two are enough: after that states repeat).
INSERTIONS: Matrix = tuple(tuple(0 if s == t else INSERT if t == NEXT[s] else 2 * INSERT if t == NEXT[NEXT[s]] else INF for t in STATES) for s in STATES)
#: Cost to come after the last row.
END: Vector = applied(INSERTIONS, tuple(0 if done else INF for done in DONE))


class Transitions:
    """Min-plus transitions by symbol (role initial, fault), and their powers of two."""

    def __init__(self) -> None:
        self.powers: dict[tuple[str, int], list[Matrix]] = {}

    def of(self, symbol: tuple[str, int]) -> Matrix:
        """Insertions, then the row itself."""
        role, fault = symbol
        row = [[INF] * 4 for _ in STATES]
        for s in STATES:
            row[s][s] = DELETE
            if fault not in (BLANK, DUPLICATE):
                more = CUT if fault == TRUNCATED else 0
                row[s][NEXT[s]] = min(row[s][NEXT[s]], REROLE + more)
                if (to := kept(role, s)) is not None:
                    row[s][to] = min(row[s][to], KEEP + more)
        return times(INSERTIONS, tuple(map(tuple, row)))

    def back(self, symbol: tuple[str, int], k: int, v: Vector) -> Vector:
        """The cost to come before ``k`` rows of ``symbol``, from that after them."""
        powers = self.powers.setdefault(symbol, [self.of(symbol)])
        while len(powers) < k.bit_length():
            powers.append(times(powers[-1], powers[-1]))
        for bit in range(k.bit_length()):
            if k >> bit & 1:
                v = applied(powers[bit], v)
        return v


#: Conversations of up to so many runs are solved once for each pattern; so many patterns are kept.
KEPT_RUNS, KEPT_PATTERNS = 32, 20_000


class Solver:
    """``solved``, remembering the patterns of short conversations."""

    def __init__(self) -> None:
        self.table = Transitions()
        self.known: dict[tuple, tuple[int, str]] = {}

    def __call__(self, runs: list[list]) -> tuple[int, str]:
        if len(runs) > KEPT_RUNS:
            return solved(runs, self.table)
        key = tuple([(s, k) for s, k in runs])
        found = self.known.get(key)
        if found is None:
            found = solved(runs, self.table)
            if len(self.known) < KEPT_PATTERNS:
                self.known[key] = found
        return found


def solved(runs: list[list], table: Transitions) -> tuple[int, str]:
    """Least cost and audit of ``runs`` ([symbol, rows] each)."""
    after = [END]
    for symbol, k in reversed(runs):
        after.append(table.back(symbol, k, after[-1]))
    cost, state, audit = after[-1][0], 0, []
    for i, (symbol, k) in enumerate(runs):
        costs = [after[-2 - i]]
        for _ in range(k):
            costs.append(table.back(symbol, 1, costs[-1]))
        role, fault = symbol
        more = CUT if fault == TRUNCATED else 0
        for j in range(k, 0, -1):
            now, then = costs[j], costs[j - 1]
            while True:
                to = kept(role, state) if fault not in (BLANK, DUPLICATE) else None
                if DELETE + then[state] == now[state]:
                    audit.append("D")
                elif INSERT + now[NEXT[state]] == now[state]:
                    audit.append("I")
                    state = NEXT[state]
                    continue
                elif to is not None and KEEP + more + then[to] == now[state]:
                    audit.append("K")
                    state = to
                else:
                    audit.append("R")
                    state = NEXT[state]
                break
    while not DONE[state]:
        audit.append("I")
        state = NEXT[state]
    return cost, "".join(audit)


class Repaired:
    """Applies an audit to rows that come one after another."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self) -> Iterator[str]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield NAMES[WANTED[self.state]] + ":"
            self.at, self.state = self.at + 1, NEXT[self.state]

    def row(self, role: str, text: str) -> Iterator[str]:
        """The repaired lines up to and with this row."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = kept(role[:1], self.state)
            yield f"{role}:{text}"
        elif edit == "R":
            yield f"{NAMES[WANTED[self.state]]}:{text}"
            self.state = NEXT[self.state]


def damaged(rows: DataFrame) -> DataFrame:
    """The stated damage: (conv_id, turn, role, text, n), n = 0 for a dropped row and 2 for a repeated one."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(hit == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("n"))


def faults(rows: DataFrame) -> DataFrame:
    """One narrow row for each distinct (conv_id, turn, role, text) of ``rows`` (with n copies), with its symbol: initial,
    blank, cut, and whether a row of the same role and text comes earlier in the conversation (repeated)."""
    end = F.rtrim("text", F.lit(BLANKS))
    keys = ["conv_id", "turn", "role", "digest", "blank", "cut"]
    cut: Column = ~F.substring(end, -1, 1).isin(".", "!", "?")
    seen = rows.select("conv_id", "turn", "role", digest().alias("digest"), (end == "").alias("blank"), cut.alias("cut"), "n").groupBy(*keys).agg(F.sum("n").alias("n"))
    seen = stage(seen, "conversation-symbols")
    first = seen.where("n > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(F.struct("turn")).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    late = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return seen.join(first, same, "left").select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "blank", "cut", "n", F.coalesce(late, F.lit(False)).alias("repeated"))


def digest() -> Column:
    return F.md5(F.col("text").cast("binary"))


def in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Whole conversations in one partition each, sorted."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *first, "turn", "role", "digest")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_AUDIT = [c.split()[0] for c in AUDIT.split(", ")]


class Conversation:
    """The runs and counts of one conversation, row by row."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.runs, self.count, self.illegal = conv, [], [0] * 4, 0
        self.least = self.turn = self.last = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: int, n: int) -> None:
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.turn = turn
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1
        self.last = initial
        self.count[fault] += n
        if self.runs and self.runs[-1][0] == (initial, fault):
            self.runs[-1][1] += n
        else:
            self.runs.append([(initial, fault), n])

    def row(self, solve: Solver) -> tuple:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.turns
        return self.conv, gaps, self.count[BLANK], self.count[DUPLICATE], self.count[TRUNCATED], self.illegal, *solve(self.runs)


def audits(rows: DataFrame) -> DataFrame:
    """Counts, least cost and audit of each conversation of ``rows`` (as ``faults`` returns them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve, now, out = Solver(), None, []
        for b in batches:
            for conv, turn, initial, blank, cut, n, repeated in zip(*(column(b, c).to_pylist() for c in ("conv_id", "turn", "initial", "blank", "cut", "n", "repeated")), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.row(solve))
                    now = Conversation(conv)
                if n:
                    now.add(turn, initial, BLANK if blank else DUPLICATE if repeated else TRUNCATED if cut else NONE, n if blank or repeated else 1)
                    if n > 1 and not (blank or repeated):
                        now.add(turn, initial, DUPLICATE, n - 1)
            if len(out) >= 1000:
                yield records(out, _AUDIT)
                out = []
        if now is not None:
            out.append(now.row(solve))
        if out:
            yield records(out, _AUDIT)

    return in_order(rows.select("conv_id", "turn", "role", "digest", "initial", "blank", "cut", "n", "repeated")).mapInArrow(run, AUDIT)


def records(rows: Iterable[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if c in ("audit", "repaired_sha256") else pa.int64() for c in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _behind_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit row (kind 0), then its rows (kind 1) in order, once for each copy."""
    copies = rows.where("n > 0").select("conv_id", "turn", "role", "text", digest().alias("digest"), F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(1), "n")).alias("_copy")).drop("_copy")
    return in_order(copies.unionByName(found.withColumn("kind", F.lit(0)), allowMissingColumns=True), "kind")


def repair(conversations: DataFrame) -> DataFrame:
    """The repaired rows of each conversation: conv_id, place (from 0), role, text, edit (K, R or I)."""
    prepare(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), F.lit(1).alias("n"))
    found = stage(audits(faults(rows)), "conversation-audits")
    kind = "conv_id long, place long, role string, text string, edit string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits = place = None
        for b in slices(batches, "text"):
            out = []
            for conv, first, role, text, audit in zip(*(column(b, c).to_pylist() for c in ("conv_id", "kind", "role", "text", "audit")), strict=True):
                if first == 0:
                    edits, place, left = Repaired(audit), 0, audit.count("K") + audit.count("R") + audit.count("D")
                    if not left:  # no rows: an audit without them is empty
                        continue
                else:
                    left -= 1
                    before = edits.at
                    lines = [x.split(":", 1) for x in edits.row(role, text)]
                    did = edits.audit[before : edits.at]
                    if not left:
                        lines += [x.split(":", 1) for x in edits.inserted()]
                        did = edits.audit[before:]
                    names = [x for x in did if x != "D"]
                    # a kept role may hold a colon itself
                    lines = [[role, text] if e == "K" else x for x, e in zip(lines, names, strict=True)]
                    for (r, t), e in zip(lines, names, strict=True):
                        out.append((conv, place, r, t, e))
                        place += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=[c.split()[0] for c in kind.split(", ")])

    return _behind_audits(rows, found).mapInArrow(run, kind)


def damage_repair(conversations: DataFrame) -> DataFrame:
    """Damage the rows, then give each conversation's fault counts, least cost, audit and the digest of its repaired lines."""
    prepare(conversations.sparkSession)
    rows = damaged(conversations)
    found = stage(audits(faults(rows)), "conversation-audits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, edits, sha, lines, out = None, None, None, 0, []

        def done() -> tuple:
            nonlocal lines
            for line in edits.inserted():
                sha.update(f"\n{line}".encode() if lines else line.encode())
                lines += 1
            return *head, sha.hexdigest()

        names = [*_AUDIT, "repaired_sha256"]
        for b in slices(batches, "text"):
            for first, role, text, *told in zip(*(column(b, c).to_pylist() for c in ("kind", "role", "text", *_AUDIT)), strict=True):
                if first == 0:
                    if head is not None:
                        out.append(done())
                    head, edits, sha, lines = told, Repaired(told[-1]), hashlib.sha256(), 0
                else:
                    for line in edits.row(role, text):
                        sha.update(f"\n{line}".encode() if lines else line.encode())
                        lines += 1
            if len(out) >= 1000:
                yield records(out, names)
                out = []
        if head is not None:
            out.append(done())
        if out:
            yield records(out, names)

    return _behind_audits(rows, found).mapInArrow(run, AUDIT + ", repaired_sha256 string")

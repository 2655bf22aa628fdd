"""Conversation repair against a search over all edit sequences."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import cache

import pytest

from blockbeam.llm import conversations as C

KIND = "conv_id long, turn long, role string, text string"


def cheapest(roles, faults):
    """(cost, audit) of the best edit sequence, by comparing whole sequences; roles are initials."""

    def after(state, r):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, r))

    @cache
    def best(i, state, room):
        ways = []
        if i == len(roles) and state in ("", "a"):
            ways.append((0, ""))
        if room:
            for r in "ua":
                if (to := after(state, r)) is not None:
                    c, a = best(i, to, room - 1)
                    ways.append((c + 2, "I" + a))
        if i < len(roles):
            c, a = best(i + 1, state, 3)
            ways.append((c + 3, "D" + a))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                for r, cost, e in ((roles[i], 0, "K"), ("u", 2, "R"), ("a", 2, "R")):
                    if (to := after(state, r)) is not None:
                        c, a = best(i + 1, to, 3)
                        ways.append((c + cost + more, e + a))
        return min(ways, default=(10**9, ""))

    return best(0, "", 3)


def wanted(rows):
    """The query's result for (conv_id, turn, role, text) rows, by its statement."""
    convs = {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        s = lambda x: " " if x is None else x
        hit = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        role, text = s(role), s(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        mine += [(turn, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    out = {}
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in mine:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        firsts = [r[1][:1] for r in mine]
        cost, audit = cheapest(tuple(firsts), tuple(faults))
        lines, state, at = [], "", iter(mine)
        for e in audit:
            if e == "D":
                next(at)
                continue
            role, text = next(at)[1:] if e != "I" else ("", "")
            if e != "K":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{text}")
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        c = Counter(faults)
        out[conv] = (gaps, c["blank"], c["duplicate"], c["truncated"], bad, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = [tuple(r)[:9] for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_all_sequences(seed):
    rnd, table = random.Random(seed), C.Transitions()
    names = ["", "blank", "duplicate", "truncated"]
    for _ in range(400):
        runs = [[(rnd.choice("suaux"), rnd.choice([0, 0, 1, 2, 3])), rnd.randrange(1, 5)] for _ in range(rnd.randrange(5))]
        merged = []
        for r in runs:
            if merged and merged[-1][0] == r[0]:
                merged[-1][1] += r[1]
            else:
                merged.append(r)
        roles = tuple(r for (r, _), k in merged for _ in range(k))
        faults = tuple(names[f] for (_, f), k in merged for _ in range(k))
        assert C.solved(merged, table) == cheapest(roles, faults)


def test_long_runs_by_powers():
    """The advance by binary powers equals single steps, and a long run needs few matrices."""
    table = C.Transitions()
    v = C.END
    for _ in range(1000):
        v = C.applied(table.of(("u", 3)), v)
    assert table.back(("u", 3), 1000, C.END) == v
    assert len(table.powers["u", 3]) == 10
    cost, audit = C.solved([[("u", 0), 100_000]], table)
    # of every two user rows one is reroled; deletion or insertion costs more
    assert (cost, Counter(audit)) == (100_000, Counter(K=50_000, R=50_000))


def odd_rows():
    rnd = random.Random(3)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randrange(9)):
            role = rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            rows.append((conv, rnd.choice([turn, turn, turn + 2, None]), role, rnd.choice(["Hi.", "Hi.", "what? ", "cut off", "", " \t", None, f"n{rnd.random()}!", "long. " * 20_000])))
    rows += rows[:7]  # repeated rows
    # ties: two texts and two roles in one turn
    rows += [(99, 1, "user", "b."), (99, 1, "user", "a."), (99, 1, "assistant", "a."), (99, 1, "user", "a.")]
    # a conversation that the damage empties, one without any turn
    gone = next(k for k in range(1000, 2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Hi."), (77, None, "user", "Hi."), (77, None, "assistant", "So.")]
    return rows


def test_query_against_brute_force(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, KIND)
    want = wanted(rows)
    assert got(C.damage_repair(df.repartition(5))) == want
    assert got(C.damage_repair(df.coalesce(1))) == want
    assert any(x[0] == 0 and x[6] == "" and x[7] == hashlib.sha256(b"").hexdigest() for x in want.values())


def test_given_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(C.damage_repair(df)) == wanted([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame(odd_rows(), KIND)
    assert C.damage_repair(df.where("conv_id < 0")).count() == 0
    from pyspark.sql import functions as F

    wide = df.withColumns({c: F.lit(None).cast("string") for c in ("kind", "audit", "n", "digest", "gaps", "cost", "blank", "c", "first", "initial", "text_")})
    assert got(C.damage_repair(wide)) == got(C.damage_repair(df))


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant:x", "a:b."), (2, 0, "assistant", "So."), (3, 0, "user", " "), (4, 0, "user", "Hi.")]
    out = sorted(map(tuple, C.repair(spark.createDataFrame(rows, KIND)).collect()))
    assert out == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant:x", "a:b.", "K"), (2, 0, "user", "", "I"), (2, 1, "assistant", "So.", "K"), (4, 0, "user", "Hi.", "K"), (4, 1, "assistant", "", "I")]
    assert C.repair(spark.createDataFrame([], KIND)).count() == 0

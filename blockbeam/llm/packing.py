"""Best-fit packing by bin completion.

Documents become token ids, cut into pieces of ``SEQUENCE`` ids at most; pieces fill sequences. The
pieces are dealt by a hash into blocks of about ``BLOCK`` pieces, and each block is packed on its own
(a block loses less than one sequence against packing all at once). A block is searched by branch and
bound: take the largest piece left, enumerate the undominated fillings of the room beside it, try them
by least waste, and give up a branch when its waste exceeds what a better solution than the incumbent
could have. The first incumbent is best-fit decreasing; the search ends when the incumbent meets the
lower bound (all ids / sequence length) or after ``NODES`` fillings. The enumeration of a bin's fillings is bounded as well: ``STEPS``
steps, the ``WIDTH`` largest sizes that fit at each, and the ``WIDTH`` best fillings found; pieces of under about 20 ids need
more steps than that for one filling, so best-fit decides there. These are bounds on time only: every piece is always placed.

Ids come from a tokenizer file. Words are encoded once per batch and kept in a bounded cache of the
worker: the tokenizer drops white space, so the ids of a text are those of its words.

Defined results: a null or empty text is a document of the closing id alone. Repeated rows are packed
as often as they occur. A null doc_id stays null. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import Words, column, prepare, slices, stage

SEQUENCE, CLOSE = 4096, 1
BLOCK, NODES, WIDTH, STEPS = 16_384, 20_000, 6, 200
CACHED = 500_000  # words whose ids a worker keeps

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RESULT = PIECES + ", sequence_id long, offset long"


class Encoder:
    """Ids of texts, by way of their distinct words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def learn(self, words: list[str], letters: list[bool]) -> None:
        """Encode words. Words of letters alone are joined by blanks: each ends with one word-end id."""
        pure = [w for w, a in zip(words, letters, strict=True) if a]
        rest = [w for w, a in zip(words, letters, strict=True) if not a]
        for i in range(0, len(pure), 1000):
            part = pure[i : i + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            cut = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cut) == len(part):
                raw = ids.tobytes()
                self.known.update(zip(part, (raw[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)), strict=True))
            else:
                rest += part
        for i in range(0, len(rest), 1000):
            part = rest[i : i + 1000]
            self.known.update(zip(part, (x.tobytes() for x in self.plain(part)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of each text's."""
        texts = pc.fill_null(texts, "")
        odd = np.zeros(len(texts), bool)
        for t in self.special:  # a special token's string is one id, whatever stands around it
            odd |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        # what the tokenizer does anyway; done first, fewer distinct words are left
        low = pc.replace_substring_regex(pc.ascii_lower(texts), "([a-zß-öø-ÿ])([.,;:!?])", r"\1 \2")
        # the blank between must not complete a special token's string; lower-casing neither
        low = pc.if_else(pa.array(odd), pa.scalar("", low.type), low)
        words = Words(low)
        distinct = words.distinct.to_pylist()
        if len(self.known) > CACHED:
            self.known.clear()
        new = [i for i, w in enumerate(distinct) if w not in self.known]
        if new:
            fresh = words.distinct.take(pa.array(new))
            special = np.zeros(len(new), bool)
            for t in self.special:  # made by lower-casing: its letters are ordinary text
                special |= pc.match_substring(fresh, t).to_numpy(zero_copy_only=False)
            if special.any():
                return self.stitched(texts)
            self.learn([distinct[i] for i in new], pc.utf8_is_alpha(fresh).to_pylist())
        each = [self.known[w] for w in distinct]
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        flat = np.frombuffer(b"".join(each), np.uint32)
        n = size[words.code]
        upto = np.cumsum(n)
        ids = flat[np.repeat(begin[words.code] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)]
        count = np.bincount(words.doc, weights=n, minlength=len(texts)).astype(np.int64)
        if odd.any():
            at = np.split(ids, np.cumsum(count)[:-1])
            for i in np.flatnonzero(odd):
                at[i] = self.plain([texts[int(i)].as_py()])[0]
            ids, count = np.concatenate(at), np.array([len(x) for x in at], np.int64)
        return ids, count

    def stitched(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        each = self.plain(texts.to_pylist())
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            ids, count = encoder(path).encode(column(b, "text"))
            ends = np.cumsum(count)
            ids = np.insert(ids, ends, CLOSE).astype("<u4")
            count = count + 1
            begin = np.cumsum(count) - count
            many = -(-count // sequence)
            doc = np.repeat(np.arange(len(count)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * sequence
            length = np.minimum(sequence, count[doc] - start)
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * x : 4 * (x + n)]) for x, n in zip((begin[doc] + start).tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def best_fit(lengths: list[int], room: int) -> list[list[int]]:
    """Best-fit decreasing; ``lengths`` fall."""
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []  # (room left, bin), rising
    for x in lengths:
        i = bisect_right(free, (x, -1))
        if i < len(free):
            left, k = free.pop(i)
        else:
            left, k = room, len(bins)
            bins.append([])
        bins[k].append(x)
        if left > x:
            insort(free, (left - x, k))
    return bins


def fillings(room: int, sizes: list[int], left: dict[int, int]) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of ``room`` from the rising ``sizes`` of which ``left`` remain: (waste, lengths), least
    waste first. Fillings that leave room for a piece are dominated, and so are those in which one
    piece that remains could stand for two without more waste."""
    found: set[tuple[int, ...]] = set()
    out: list[tuple[int, tuple[int, ...]]] = []
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, len(sizes), ())]
    steps = 0
    while stack and steps < STEPS and len(out) < 4 * WIDTH:
        free, top, chosen = stack.pop()
        steps += 1
        i = min(top, bisect_right(sizes, free)) - 1
        options = []
        while i >= 0 and len(options) < WIDTH:
            if left[sizes[i]] > chosen.count(sizes[i]):
                options.append(i)
            i -= 1
        if not options:
            if chosen in found:
                continue
            found.add(chosen)
            pairs = {a + b for k, a in enumerate(chosen) for b in chosen[k + 1 :]} if len(chosen) < 12 else set()
            if free and any((j := bisect_right(sizes, s + free) - 1) >= 0 and sizes[j] >= s and left[sizes[j]] > chosen.count(sizes[j]) for s in pairs):
                continue
            out.append((free, chosen))
            if not free:
                break
            continue
        stack.extend((free - sizes[i], i + 1, (*chosen, sizes[i])) for i in reversed(options))
    return sorted(out)[:WIDTH]


def complete(lengths: list[int], room: int, nodes: int = NODES) -> list[list[int]]:
    """Pack ``lengths`` into as few bins of ``room`` as the search finds; bins are lists of lengths."""
    lengths = sorted(lengths, reverse=True)
    full = [[x] for x in lengths if x >= room]
    rest = lengths[len(full) :]
    best = best_fit(rest, room)
    bound = -(-sum(rest) // room)
    left: dict[int, int] = {}
    for x in rest:
        left[x] = left.get(x, 0) + 1
    sizes = sorted(left)
    budget = nodes

    def take(x: int, n: int) -> None:
        left[x] = left.get(x, 0) + n
        if n > 0 and left[x] == n:
            insort(sizes, x)
        elif not left[x]:
            sizes.pop(bisect_right(sizes, x) - 1)

    # depth-first: each level has one bin, its fillings yet to try, and its waste
    levels: list[tuple[int, list[tuple[int, tuple[int, ...]]], tuple[int, tuple[int, ...]] | None]] = []
    waste = 0
    while len(best) > bound and budget > 0:
        spare = (len(best) - 1) * room - sum(rest)  # a better solution wastes no more than this
        if not sizes:
            best = [[x, *f[1]] for x, _, f in levels if f]
            down = False
        else:
            x = sizes[-1]
            take(x, -1)
            levels.append((x, fillings(room - x, sizes, left) or [(room - x, ())], None))
            down = True
        while levels:
            x, options, now = levels.pop()
            if now:
                waste -= now[0]
                for y in now[1]:
                    take(y, 1)
            if down or now is not None:
                option = next(iter(options), None)
                if option and waste + option[0] <= spare and budget > 0:
                    budget -= 1
                    waste += option[0]
                    for y in option[1]:
                        take(y, -1)
                    levels.append((x, options[1:], option))
                    break
            take(x, 1)
            down = False
        if not levels:
            break
    return full + best


def pack(rows: pd.DataFrame, room: int, nodes: int = NODES) -> pd.DataFrame:
    """Add sequence_id (from 0) and offset to the pieces of one block."""
    order = rows["length"].to_numpy().argsort(kind="stable")
    at: dict[int, list[int]] = {}
    lengths = rows["length"].to_numpy()
    for i in order:
        at.setdefault(int(lengths[i]), []).append(int(i))
    sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    for k, bin_ in enumerate(complete(lengths.tolist(), room, nodes)):
        upto = 0
        for x in bin_:
            i = at[x].pop()
            sequence[i], offset[i] = k, upto
            upto += x
    return rows.assign(sequence_id=sequence, offset=offset)


def packing(docs: DataFrame, path: str, *, sequence: int = SEQUENCE, block: int = BLOCK, nodes: int = NODES) -> DataFrame:
    """Cut every row of ``docs`` (doc_id, text) into pieces and place them."""
    prepare(docs.sparkSession)
    cut = stage(pieces(docs, path, sequence), "pieces")
    blocks = -(-cut.count() // block) or 1
    # the place in the staged table parts the pieces of repeated rows, which differ in nothing else
    dealt = cut.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(blocks)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        out = pack(pdf, sequence, nodes)
        out["sequence_id"] += pdf["_block"] * (1 << 32)
        return out.drop(columns="_block")

    return dealt.groupBy("_block").applyInPandas(fill, RESULT)

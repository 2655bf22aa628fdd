import hashlib
import os

import pytest

from blockbeam.plans.blockfiles import encode_block, write_block_files
from blockbeam.sources import blocks as B

MAGIC = B.BLOCK_MAGIC


def frame(payload, magic=MAGIC):
    return magic.to_bytes(4, "little") + len(payload).to_bytes(4, "little") + payload


def _txs(k):
    return [{"txid": "", "outs": [{"amount_sat": 625000000 + k, "script": "aa" * 3}]},
            {"txid": "", "outs": [{"amount_sat": 100 + j, "script": f"{j:02x}" * 25} for j in range(k + 1)]}]


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_frames_out_of_order_and_padding(spark, tmp_out):
    d = tmp_out("blk").removeprefix("file:")
    payloads = [encode_block(t, 70 + t % 3, _txs(t % 4)) for t in (300, 100, 200)]
    _write(f"{d}/a.dat", b"".join(frame(p) for p in payloads) + b"\x00" * 64)
    rows = B.read_block_files(spark, d, glob="*.dat").orderBy("time").collect()
    assert [r.time for r in rows] == [100, 200, 300]
    ends = [sum(8 + len(p) for p in payloads[:k]) for k in range(3)]
    assert [r.offset for r in rows] == [ends[1], ends[2], ends[0]]
    r = rows[0]
    assert len(r.txs) == 2 and r.txs[0].outs[0].amount_sat == 625000000 + 0
    # the block id is the reversed double SHA-256 of the 80-byte header
    header = payloads[1][:80]
    assert r.block_id == hashlib.sha256(hashlib.sha256(header).digest()).digest()[::-1].hex()
    frames = B.read_block_frames(spark, d, glob="*.dat").orderBy("frame_idx").collect()
    assert [(f.offset, f.size) for f in frames][0] == (0, len(payloads[0]))


@pytest.mark.parametrize("bad", ["magic", "truncated"])
def test_bad_frames(spark, tmp_out, bad):
    d = tmp_out("blkbad").removeprefix("file:")
    good = frame(encode_block(100, 1, _txs(1)))
    tail = frame(encode_block(200, 1, _txs(2)), magic=0x12345678) if bad == "magic" else good[:-5]
    _write(f"{d}/b.dat", good + tail)
    with pytest.raises(Exception, match="BadFrame"):
        B.read_block_files(spark, d, glob="*.dat").collect()
    assert B.read_block_files(spark, d, on_bad="skip", glob="*.dat").count() == 1


def test_skip_goes_on_at_the_next_frame_and_reports(spark, tmp_out):
    d = tmp_out("blkskip").removeprefix("file:")
    one, two = (frame(encode_block(t, 1, _txs(2))) for t in (100, 200))
    _write(f"{d}/b.dat", one + b"junk that is no frame" + two + two[:-5])
    rows = B.read_block_files(spark, d, on_bad="skip", glob="*.dat").collect()
    assert sorted(r.time for r in rows) == [100, 200]
    f = B.read_block_frames(spark, d, on_bad="skip", glob="*.dat").orderBy("offset").collect()
    assert [r.magic_ok for r in f] == [True, False, True, False]
    assert [(r.offset, r.size + 8) for r in f][1] == (len(one), len("junk that is no frame"))
    # frames and skipped spans cover the file
    assert sum(r.size + 8 for r in f) == len(one) + 21 + len(two) + len(two) - 5


def test_segwit_txid_excludes_witness():
    def v(n):
        return bytes([n])
    ins = b"\x11" * 32 + (0).to_bytes(4, "little") + v(0) + b"\xff\xff\xff\xff"
    outs = (5000).to_bytes(8, "little") + v(2) + b"\x51\x52"
    witness = v(2) + v(3) + b"abc" + v(1) + b"z"
    ver, lock = (2).to_bytes(4, "little"), (0).to_bytes(4, "little")
    tx = ver + b"\x00\x01" + v(1) + ins + v(1) + outs + witness + lock
    header = b"\x00" * 68 + (1234).to_bytes(4, "little") + b"\x00" * 8
    block = B.decode_block(header + v(1) + tx)
    legacy = ver + v(1) + ins + v(1) + outs + lock
    want = hashlib.sha256(hashlib.sha256(legacy).digest()).digest()[::-1].hex()
    assert block["time"] == 1234 and block["txs"][0]["txid"] == want
    assert block["txs"][0]["outs"] == [{"amount_sat": 5000, "script": "5152"}]


def test_writer_round_trip(spark, tmp_out):
    rows = [(t, 80, [{"txid": "x", "outs": [{"amount_sat": t, "script": "ab"}]}]) for t in range(10)]
    df = spark.createDataFrame(rows, "time long, nonce long, txs array<struct<txid: string, "
                                     "outs: array<struct<amount_sat: bigint, script: string>>>>")
    d = tmp_out("blkw")
    summary = write_block_files(df, d, 3).collect()
    assert sum(r.n_blocks for r in summary) == 10
    back = B.read_block_files(spark, d, glob="*.dat").orderBy("time").collect()
    assert [r.time for r in back] == list(range(10))
    assert [r.txs[0].outs[0].amount_sat for r in back] == list(range(10))


def test_any_cut_gives_the_same_rows(spark, tmp_out):
    """Ranges of 1 byte and more: payloads that hold the magic, and even a frame's head, don't mislead them."""
    d = tmp_out("blkcut").removeprefix("file:")
    decoy = MAGIC.to_bytes(4, "little") + (12).to_bytes(4, "little")
    scripts = [decoy.hex() * 5, "ab" * 300, MAGIC.to_bytes(4, "little").hex()]
    blocks = [encode_block(t, t, [{"outs": [{"amount_sat": t, "script": s} for s in scripts]}]) for t in range(40)]
    _write(f"{d}/a.dat", b"".join(frame(b) for b in blocks) + b"\x00" * 3000)
    _write(f"{d}/b.dat", frame(blocks[0]))
    _write(f"{d}/c.dat", b"")
    _write(f"{d}/_skipped.dat", b"no frame")
    want = None
    for size in (100, 997, 5_000, 1 << 20):
        rows = sorted(map(tuple, B.read_block_files(spark, d, glob="*.dat", range_bytes=size).select("file", "offset", "time", "block_id", "txs").collect()))
        frames = sorted(map(tuple, B.read_block_frames(spark, d, glob="*.dat", range_bytes=size).collect()))
        want = want or (rows, frames)
        assert (rows, frames) == want
    assert [r[2] for r in want[0]] == [*range(40), 0]
    assert [f[1] for f in want[1]] == [*range(40), 0] and all(f[4] for f in want[1])


def test_a_block_inside_a_block(spark, tmp_out):
    """A payload that holds a whole framed block: read well uncut; a cut in front of it is noticed, not misread."""
    d = tmp_out("blkdecoy").removeprefix("file:")
    inner = frame(encode_block(7, 7, _txs(1)))
    outer = frame(encode_block(1, 1, [{"outs": [{"amount_sat": 1, "script": "00" * 4000 + inner.hex() + "00" * 4000}]}]))
    _write(f"{d}/a.dat", outer + frame(encode_block(2, 2, _txs(1))))
    assert sorted(r.time for r in B.read_block_files(spark, d).collect()) == [1, 2]
    with pytest.raises(Exception, match="inside another"):
        B.read_block_files(spark, d, range_bytes=1000).collect()


def test_skipping_does_not_depend_on_cuts(spark, tmp_out):
    """Junk, a size that is too large, a truncated end: the same rows and spans wherever the file is cut."""
    d = tmp_out("blkskipcut").removeprefix("file:")
    good = [frame(encode_block(t, 1, _txs(2))) for t in range(12)]
    wrong = MAGIC.to_bytes(4, "little") + (2 * len(good[0]) + 5).to_bytes(4, "little") + good[0][8:]
    data = b"junk" * 9 + good[0] + good[1] + wrong + b"".join(good[2:9]) + b"\x00" * 40 + b"x" * 50 + good[9] + good[10] + good[11][:-3]
    _write(f"{d}/a.dat", data)
    want = None
    for size in (64, 300, 1000, 1 << 20):
        times = sorted(r.time for r in B.read_block_files(spark, d, on_bad="skip", range_bytes=size).collect())
        f = B.read_block_frames(spark, d, on_bad="skip", range_bytes=size).orderBy("offset").collect()
        assert [r.frame_idx for r in f] == list(range(len(f)))
        at = 0
        for r in f:  # frames and skipped spans cover the file
            assert r.offset == at
            at += r.size + 8
        assert at == len(data)
        got = (times, [(r.offset, r.magic_ok) for r in f])
        want = want or got
        assert got == want
        with pytest.raises(Exception, match="BadFrame"):
            B.read_block_files(spark, d, range_bytes=size).collect()
    assert want[0] == [0, 1, *range(2, 11)]


def test_a_large_file_is_read_by_several_tasks(spark, tmp_out):
    """One file of 300 MB: several tasks each read a part, and no task the whole."""
    from pyspark.sql import functions as F

    d = tmp_out("blklarge").removeprefix("file:")
    one = [frame(encode_block(t, 1, [{"outs": [{"amount_sat": t, "script": "ab" * 1_000_000}]}])) for t in range(300)]
    _write(f"{d}/large.dat", b"".join(one))
    rows = B.read_block_files(spark, d, range_bytes=32 << 20).select("time", "offset", F.spark_partition_id().alias("task")).collect()
    frames = B.read_block_frames(spark, d, range_bytes=32 << 20).orderBy("offset").collect()
    assert sorted(r.time for r in rows) == list(range(300))
    assert [(f.frame_idx, f.offset) for f in frames] == [(k, k * len(one[0])) for k in range(300)]
    tasks = {r.task for r in rows}
    assert len(tasks) >= 9 and max(sum(r.task == t for r in rows) for t in tasks) <= 40


def test_many_small_files_share_tasks(spark, tmp_out):
    d = tmp_out("blksmall").removeprefix("file:")
    for k in range(50):
        _write(f"{d}/x{k % 5}/f{k}.dat", frame(encode_block(k, 1, _txs(1))))
    df = B.read_block_files(spark, d, glob="f*.dat", range_bytes=2000)
    assert sorted(r.time for r in df.collect()) == list(range(50))
    assert 1 < df.rdd.getNumPartitions() < 20

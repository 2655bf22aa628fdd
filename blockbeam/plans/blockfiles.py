"""Block files made from stand-in rows: the input of the block source's queries and tests.

Blocks carry one placeholder input per transaction; receivers are written as scripts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.scalars import BLOCK_MAGIC
from ..sources.files import opened, qualified


def _varint(n: int) -> bytes:
    if n < 0xFD:
        return bytes([n])
    if n <= 0xFFFF:
        return b"\xfd" + n.to_bytes(2, "little")
    if n <= 0xFFFFFFFF:
        return b"\xfe" + n.to_bytes(4, "little")
    return b"\xff" + n.to_bytes(8, "little")


def encode_block(time: int, nonce: int, txs: list) -> bytes:
    """Serialize a block whose transactions carry one placeholder input each."""
    header = (1).to_bytes(4, "little") + b"\x00" * 64 + int(time).to_bytes(4, "little") + \
        (0x1D00FFFF).to_bytes(4, "little") + int(nonce).to_bytes(4, "little")
    body = [_varint(len(txs))]
    for tx in txs:
        parts = [(1).to_bytes(4, "little"), _varint(1), b"\x00" * 32, b"\xff\xff\xff\xff", _varint(0),
                 b"\xff\xff\xff\xff", _varint(len(tx["outs"]))]
        for o in tx["outs"]:
            script = bytes.fromhex(o["script"])
            parts += [int(o["amount_sat"]).to_bytes(8, "little", signed=True), _varint(len(script)), script]
        parts.append((0).to_bytes(4, "little"))
        body.append(b"".join(parts))
    return header + b"".join(body)


def write_block_files(blocks: DataFrame, path: str, n_files: int, magic: int = BLOCK_MAGIC) -> DataFrame:
    """Write nested block rows (time, nonce, txs) as framed block files, one file per
    partition, named by partition id (a retried task rewrites the same name).
    Returns the per-file summary rows (an action must run it)."""
    base = qualified(blocks.sparkSession, path).rstrip("/")

    def write(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.attemptNumber()
        fs, root = opened(base)
        fs.create_dir(root, recursive=True)
        final, tmp = f"{root}/blk{pid:05d}.dat", f"{root}/.blk{pid:05d}.dat.{attempt}"
        n_blocks = n_bytes = 0
        with fs.open_output_stream(tmp) as out:
            for b in batches:
                for row in b.to_pylist():
                    payload = encode_block(row["time"], row["nonce"], row["txs"])
                    out.write(int(magic).to_bytes(4, "little") + len(payload).to_bytes(4, "little") + payload)
                    n_blocks += 1
                    n_bytes += 8 + len(payload)
        if n_blocks:
            fs.move(tmp, final)
        else:
            fs.delete_file(tmp)
        yield pa.RecordBatch.from_pylist([{"file": final, "n_blocks": n_blocks, "n_bytes": n_bytes}])

    # round-robin: equal-sized files however blocks cluster in time
    return (blocks.select("time", "nonce", "txs").repartition(n_files)
            .mapInArrow(write, "file string, n_blocks long, n_bytes long"))

"""Token ids as compressed binary blocks: a static range asymmetric numeral system with interleaved lanes.

Table: each id's share of 2**BITS slots, one table for all blocks. Block: whole documents, coded by ``LANES`` lanes that
take ids in turn; it is decoded without any other block. Layout of a block, little-endian:

    magic u32 | lanes u32 | ids u64 | documents u32 | checkpoints u32 | words u64 | crc32 of the ids u32 | table id u32
    lengths of the documents u32 each
    for each checkpoint: step u64, word u64, then the state of each lane u64
    words u32 each

Checkpoint 0 is the block's beginning; another follows every ``EVERY`` steps, so parts of a block decode apart.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BITS, LANES, EVERY = 16, 1024, 128
#: The format's first word and the lowest state.
MAGIC, LOW = 0x52414E53, 1 << 31
HEAD = struct.Struct("<IIQIIQII")


class Table:
    """Slots by id. Every id that was counted has one slot at least; unseen ids have none."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, bits: int = BITS):
        order = np.argsort(ids)
        ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.float64)[order]
        self.bits = max(bits, int(len(ids)).bit_length())
        slots = 1 << self.bits
        size = int(ids[-1]) + 1 if len(ids) else 1
        share = np.zeros(0, np.int64)
        if len(ids):
            share = 1 + np.floor(counts * ((slots - len(ids)) / counts.sum())).astype(np.int64)
            share[np.argmax(share)] += slots - share.sum()
        self.freq, self.first = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[ids] = share
        self.first[ids] = np.cumsum(share) - share
        self.id_at = np.repeat(ids, share).astype(np.uint32)
        self.name = zlib.crc32(self.freq.tobytes())


def encode(docs: list[np.ndarray], table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    """One block of whole documents."""
    ids = np.concatenate(docs).astype("<u4") if docs else np.zeros(0, "<u4")
    n, bits = len(ids), np.uint64(table.bits)
    lanes = min(lanes, max(1, n))
    steps = -(-n // lanes)
    grid = np.zeros(steps * lanes, np.int64)
    grid[:n] = ids
    grid = grid.reshape(steps, lanes)
    limit = np.uint64((LOW >> table.bits) << 32)
    state = np.full(lanes, LOW, np.uint64)
    chunks: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    for step in range(steps - 1, -1, -1):
        width = min(lanes, n - step * lanes)
        x, row = state[:width], grid[step, :width]
        f = table.freq[row]
        full = x >= limit * f
        if full.any():
            chunks.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
        state[:width] = ((x // f) << bits) + x % f + table.first[row]
        if step % every == 0:
            marks.append((step, sum(map(len, chunks)) if step else 0, state.copy()))
    total = sum(map(len, chunks))
    words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
    head = HEAD.pack(MAGIC, lanes, n, len(docs), len(marks), len(words), zlib.crc32(ids.tobytes()), table.name)
    parts = [head, np.array([len(d) for d in docs], "<u4").tobytes()]
    for step, after, lane_states in reversed(marks):
        parts += [struct.pack("<QQ", step, total - after if step else 0), lane_states.astype("<u8").tobytes()]
    return b"".join([*parts, words.tobytes()])


def parse(block: bytes) -> dict:
    magic, lanes, n, docs, marks, n_words, crc, table = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at = HEAD.size
    lengths = np.frombuffer(block, "<u4", docs, at)
    at += 4 * docs
    points = []
    for _ in range(marks):
        step, word = struct.unpack_from("<QQ", block, at)
        points.append((step, word, np.frombuffer(block, "<u8", lanes, at + 16)))
        at += 16 + 8 * lanes
    words = np.frombuffer(block, "<u4", n_words, at)
    return {"lanes": lanes, "n": n, "lengths": lengths, "points": points, "words": words, "crc": crc, "table": table}


def decode_part(block: dict, table: Table, k: int) -> np.ndarray:
    """The ids from checkpoint ``k`` to the next one; parts decode independently."""
    lanes, n, words, bits = block["lanes"], block["n"], block["words"].astype(np.uint64), np.uint64(table.bits)
    step, at, states = block["points"][k]
    stop = block["points"][k + 1][0] if k + 1 < len(block["points"]) else -(-n // lanes)
    state, mask, out = states.astype(np.uint64).copy(), np.uint64((1 << table.bits) - 1), []
    for s in range(step, stop):
        width = min(lanes, n - s * lanes)
        x = state[:width]
        slot = x & mask
        ids = table.id_at[slot.astype(np.int64)]
        x = table.freq[ids] * (x >> bits) + slot - table.first[ids]
        low = np.flatnonzero(x < np.uint64(LOW))
        if len(low):
            x[low] = (x[low] << np.uint64(32)) | words[at : at + len(low)]
            at += len(low)
        state[:width] = x
        out.append(ids)
    if stop * lanes >= n and (at != len(words) or (state != np.uint64(LOW)).any()):
        raise ValueError("a block does not end where its coding began")
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def decode(block: bytes, table: Table) -> list[np.ndarray]:
    """The documents of a block, its checksum verified."""
    parsed = parse(block)
    if parsed["table"] != table.name:
        raise ValueError("the block was written with another table")
    parts = [decode_part(parsed, table, k) for k in range(len(parsed["points"]))]
    ids = (np.concatenate(parts) if parts else np.zeros(0, np.uint32)).astype("<u4")
    if zlib.crc32(ids.tobytes()) != parsed["crc"]:
        raise ValueError("checksum of a block does not match")
    return np.split(ids, np.cumsum(parsed["lengths"])[:-1].astype(np.int64)) if len(parsed["lengths"]) else []

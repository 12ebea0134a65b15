"""Static range asymmetric numeral system for arrays of token ids.

A chunk holds one frequency table that all its blocks share. A block is coded on
its own by ``LANES`` interleaved coders: its checkpoint keeps their start states,
the place of its first word and a checksum, so any range of blocks can be decoded
without the rest. Numpy steps all lanes of all blocks together.

Chunk: header, table, checkpoints, words, each little-endian.
"""

import struct
import zlib

import numpy as np

MAGIC = b"rANS"
HEADER = struct.Struct("<4sBBHIII")  # magic, bits, lanes' log2, steps, tokens, blocks, table bytes
BITS = 18
LANES_LOG, STEPS = 6, 512
LANES = 1 << LANES_LOG
BLOCK = LANES * STEPS
LOWEST = np.uint64(1 << 31)
WORD = np.uint64(32)
CHECKPOINT = np.dtype([("word", "<u4"), ("crc32", "<u4"), ("states", "<u8", (LANES,))])


#: Ids below this are counted and looked up in plain arrays.
DENSE = 1 << 22


def _places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids that occur, how often, and the place of each id among them."""
    if int(ids.max()) >= DENSE:
        symbols, places, counts = np.unique(ids, return_inverse=True, return_counts=True)
        return symbols, counts, places.astype(np.uint32)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    place = np.zeros(len(counts), dtype=np.uint32)
    place[symbols] = np.arange(len(symbols), dtype=np.uint32)
    return symbols, counts[symbols], place[ids]


def frequencies(symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that sum to ``2**BITS``."""
    if len(symbols) > 1 << BITS:
        raise ValueError(f"more than {1 << BITS} different ids in a chunk")
    total = 1 << BITS
    freq = np.maximum(1, counts * total // counts.sum())
    order = np.argsort(-counts, kind="stable")
    rest = total - int(freq.sum())
    if rest > 0:
        freq[order[0]] += rest
    for place in order:
        if rest >= 0:
            break
        less = min(-rest, int(freq[place]) - 1)
        freq[place] -= less
        rest += less
    return freq.astype(np.uint64)


def encode(ids: np.ndarray) -> bytes:
    """One chunk of unsigned 32-bit ids; an empty array gives a chunk without blocks."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if not len(ids):
        return HEADER.pack(MAGIC, BITS, LANES_LOG, STEPS, 0, 0, 0)
    symbols, counts, places = _places(ids)
    freq = frequencies(symbols, counts)
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    blocks = -(-len(ids) // BLOCK)
    padded = np.zeros(blocks * BLOCK, dtype=np.uint32)
    padded[: len(ids)] = places
    steps = padded.reshape(blocks, STEPS, LANES).transpose(1, 0, 2).reshape(STEPS, blocks * LANES)

    states = np.full(blocks * LANES, LOWEST, dtype=np.uint64)
    words = np.zeros((STEPS, blocks * LANES), dtype="<u4")
    given = np.zeros((STEPS, blocks * LANES), dtype=bool)
    bound = np.uint64(((1 << 31) >> BITS) << 32)
    for t in range(STEPS - 1, -1, -1):
        f, c = freq[steps[t]], start[steps[t]]
        full = states >= bound * f
        words[t] = states.astype("<u4")
        given[t] = full
        states = np.where(full, states >> WORD, states)
        quotient = states // f
        states = (quotient << np.uint64(BITS)) + (states - quotient * f) + c

    by_block = given.reshape(STEPS, blocks, LANES).transpose(1, 0, 2)
    stream = words.reshape(STEPS, blocks, LANES).transpose(1, 0, 2)[by_block]
    sizes = by_block.sum((1, 2))
    marks = np.zeros(blocks, dtype=CHECKPOINT)
    marks["word"] = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    marks["states"] = states.reshape(blocks, LANES)
    marks["crc32"] = [zlib.crc32(ids[b * BLOCK : (b + 1) * BLOCK]) for b in range(blocks)]
    gaps = np.diff(symbols, prepend=0).astype("<u4")
    table = zlib.compress(gaps.tobytes() + freq.astype("<u4").tobytes(), 6)
    head = HEADER.pack(MAGIC, BITS, LANES_LOG, STEPS, len(ids), blocks, len(table))
    return b"".join([head, table, marks.tobytes(), stream.tobytes()])


def decode(chunk: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks from ``first`` up to ``last`` (exclusive; None: all).

    Raises ``ValueError`` where the format or a checksum does not fit.
    """
    magic, bits, lanes_log, steps, count, blocks, table_size = HEADER.unpack_from(chunk)
    if magic != MAGIC or lanes_log != LANES_LOG:
        raise ValueError("not a chunk of this format")
    last = blocks if last is None else min(last, blocks)
    if first >= last:
        return np.zeros(0, dtype="<u4")
    at = HEADER.size
    table = np.frombuffer(zlib.decompress(chunk[at : at + table_size]), dtype="<u4")
    gaps, freq32 = np.split(table, 2)
    symbols, freq = np.cumsum(gaps, dtype=np.uint32), freq32.astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    at += table_size
    marks = np.frombuffer(chunk, dtype=CHECKPOINT, count=blocks, offset=at)[first:last]
    words = np.frombuffer(chunk, dtype="<u4", offset=at + blocks * CHECKPOINT.itemsize)
    words = np.append(words, np.uint32(0)).astype(np.uint64)  # a place to look at when none is due

    slots = np.repeat(np.arange(len(symbols), dtype=np.uint32), freq32)
    low = np.uint64((1 << bits) - 1)
    shift = np.uint64(bits)
    n = last - first
    states = marks["states"].reshape(-1).copy()
    pointer = marks["word"].astype(np.int64)
    out = np.zeros((steps, n * LANES), dtype=np.uint32)
    for t in range(steps):
        slot = states & low
        symbol = slots[slot]
        out[t] = symbol
        states = freq[symbol] * (states >> shift) + slot - start[symbol]
        due = states < LOWEST
        if due.any():
            wanted = due.reshape(n, LANES)
            before = np.cumsum(wanted, axis=1)
            where = (pointer[:, None] + before - 1).reshape(-1)[due]
            states[due] = (states[due] << WORD) | words[where]
            pointer += before[:, -1]
    ids = symbols[out.reshape(steps, n, LANES).transpose(1, 0, 2).reshape(-1)].astype("<u4")
    ids = ids[: count - first * BLOCK] if last == blocks else ids
    for i, mark in enumerate(marks):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK]) != mark["crc32"]:
            raise ValueError(f"block {first + i} is damaged")
    return ids

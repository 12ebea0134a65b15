"""Alignment of two tokenizations of the same texts.

Both tokenizers spell out the same bytes, so a tokenization is the ascending list
of the byte offsets at which its tokens end. Where both lists hold an offset, the
text is cut into groups. Along stretches in which tokens match one to one, the
lists are equal at a fixed shift of their indexes; exponential probing jumps over
such a stretch in a few comparisons. Where they differ, the shorter side is
advanced until the offsets meet again, which gives the next shift.

How often two ids are linked in the whole corpus is counted by Spark, and looked
up again for the links of every document.
"""

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import body
from spinneret.operators.joins import lookup_join
from spinneret.operators.scratch import settle

#: Characters of text that are aligned at once; a longer text is taken alone.
TEXT_AT_ONCE = 1 << 20
#: Bytes that a task remembers pieces in, twice, and pieces encoded as one text.
MEMORY = 80 << 20
ENTRY_BYTES = 330
PIECES_AT_ONCE = 2000

#: White space beyond what Python strips.
WHITE = "\u180e"
SCHEMA = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
    "links array<struct<pair:bigint,times:bigint>>"
)


# Tokenizers

def byte_alphabet() -> dict[str, int]:
    """The letters that spell the bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """A byte-level BPE file of the tokenizers library; it sees a blank before each text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_alphabet()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self.tokenizer.get_vocab()
        self.spelt = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelt[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.sizes = np.array([len(b) for b in self.spelt], dtype=np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]


class PieceTokenizer:
    """A sentencepiece model, which adds the blank by itself."""

    BLANK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.spelt = [
            bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace(self.BLANK, " ").encode()
            for p in pieces
        ]
        self.sizes = np.array([len(b) for b in self.spelt], dtype=np.int64)
        #: No piece goes on over a blank, so words are encoded apart.
        self.apart = not any(self.BLANK in p.lstrip(self.BLANK) for p in pieces)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype="<u4") for ids in self.model.encode(texts, num_threads=1)]


class _Pair:
    """Both tokenizers with a bounded memory for the pieces between single blanks."""

    def __init__(self, byte_path: str, piece_path: str):
        self.both = (ByteTokenizer(byte_path), PieceTokenizer(piece_path))
        self.young: tuple[dict, dict] = ({}, {})
        self.old: tuple[dict, dict] = ({}, {})
        self.held = 0
        a, b = (t.spelt for t in self.both)
        #: How ids are written within a group: A before "," and "|", B before "," and ";".
        self.written = [
            str(i).encode() + end for spelt, end in ((a, b","), (a, b"|"), (b, b","), (b, b";"))
            for i in range(len(spelt))
        ]

    def _right(self, side: int, ids: np.ndarray, text: str) -> bool:
        spelt = self.both[side].spelt
        return b"".join([spelt[i] for i in ids.tolist()]) == b" " + text.encode("utf-8", "surrogatepass")

    def _coded(self, side: int, pieces: list[str]) -> list[bytes | None]:
        """Ids of every piece behind its blank: encoded as one text, and cut where they end."""
        text = " ".join(pieces)
        ids = self.both[side].encode([text])[0]
        ends = np.cumsum(self.both[side].sizes[ids])
        wanted = np.cumsum([len(p.encode()) + 1 for p in pieces])
        cuts = np.minimum(np.searchsorted(ends, wanted), max(len(ends) - 1, 0))
        if len(ends) and (ends[cuts] == wanted).all() and self._right(side, ids, text):
            data, bounds = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()]
            return [data[a:b] for a, b in zip(bounds, bounds[1:])]
        if len(pieces) == 1:
            return [None]
        half = len(pieces) // 2
        return self._coded(side, pieces[:half]) + self._coded(side, pieces[half:])

    def _learn(self, wanted: set[str]) -> None:
        young, old = self.young, self.old
        fresh = []
        for piece in wanted - young[0].keys():
            if piece in old[0]:
                for side in (0, 1):
                    young[side][piece] = old[side][piece]
            elif not piece or piece.strip(WHITE) != piece or piece.strip() != piece:
                young[0][piece] = young[1][piece] = None  # the tokenizers may join the blank with it
            else:
                fresh.append(piece)
        for at in range(0, len(fresh), PIECES_AT_ONCE):
            some = fresh[at : at + PIECES_AT_ONCE]
            for side in (0, 1):
                young[side].update(zip(some, self._coded(side, some)))
        self.held += sum(ENTRY_BYTES + 4 * len(piece) for piece in fresh)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of every text by both as little-endian unsigned 32-bit integers.

        Both are empty where the text is, or where one of them spells other bytes.
        """
        split = [t.split(" ") if t and self.both[1].apart else None for t in texts]
        self._learn({piece for pieces in split if pieces for piece in pieces})
        found = []
        a, b = (d.__getitem__ for d in self.young)
        for text, pieces in zip(texts, split):
            if pieces:
                try:
                    found.append((b"".join(map(a, pieces)), b"".join(map(b, pieces))))
                    continue
                except TypeError:  # a piece that cannot be encoded apart
                    pass
            ids = [t.encode([text])[0] for t in self.both] if text else []
            right = bool(ids) and all(self._right(side, i, text) for side, i in enumerate(ids))
            found.append(tuple(i.tobytes() for i in ids) if right else (b"", b""))
        if self.held > MEMORY:
            self.old, self.young, self.held = self.young, ({}, {}), 0
        return found


# Diagonals

def diagonal_runs(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Rows ``i, j, n``: the ``n`` ends from ``i`` on equal those from ``j`` on.

    The runs hold all common ends of two ascending lists, in order. Within a run,
    probes of doubled width jump ahead while they match, and of halved width find
    its end.
    """
    a, b = ends_a.tolist(), ends_b.tolist()
    bytes_a, bytes_b = (np.ascontiguousarray(e, dtype="<i8").tobytes() for e in (ends_a, ends_b))
    runs = []
    i = j = 0
    n_a, n_b = len(a), len(b)
    while i < n_a and j < n_b:
        x, y = a[i], b[j]
        if x < y:
            i += 1
        elif y < x:
            j += 1
        else:
            length = width = 1
            room = min(n_a - i, n_b - j)
            while width and length < room:
                step = min(width, room - length)
                at, to = 8 * (i + length), 8 * (j + length)
                if bytes_a[at : at + 8 * step] == bytes_b[to : to + 8 * step]:
                    length += step
                    width *= 2
                elif step == 1:
                    break
                else:
                    # Narrow down: the first difference lies within this probe.
                    while step > 1:
                        half = step // 2
                        at, to = 8 * (i + length), 8 * (j + length)
                        if bytes_a[at : at + 8 * half] == bytes_b[to : to + 8 * half]:
                            length += half
                            step -= half
                        else:
                            step = half
                    width = 0
            runs.append((i, j, length))
            i += length
            j += length
    return np.array(runs, dtype=np.int64).reshape(-1, 3)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes in both lists of every common end."""
    runs = diagonal_runs(ends_a, ends_b)
    lengths = runs[:, 2]
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(runs[:, 0], lengths) + within, np.repeat(runs[:, 1], lengths) + within


def _written_order(
    ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, n_a: int, n_b: int
) -> np.ndarray:
    """Places in ``_Pair.written`` of all ids, group after group, A before B."""
    at_a, at_b = np.arange(len(ids_a)), np.arange(len(ids_b))
    group_a, group_b = np.searchsorted(cut_a, at_a), np.searchsorted(cut_b, at_b)
    before_b = np.concatenate([[0], cut_b + 1])
    order = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    last_a, last_b = cut_a[group_a] == at_a, cut_b[group_b] == at_b
    order[at_a + before_b[group_a]] = ids_a + n_a * last_a
    order[at_b + cut_a[group_b] + 1] = ids_b + 2 * n_a + n_b * last_b
    return order


def _aligned(pair: _Pair, texts: list[str]) -> dict[str, pa.Array]:
    """What is known of every text by itself."""
    coded = pair.encode(texts)
    ids_a, ids_b = (np.frombuffer(b"".join(c[side] for c in coded), dtype="<u4") for side in (0, 1))
    tokens = np.array([[len(x) // 4 for x in c] for c in coded], dtype=np.int64).reshape(-1, 2)
    ends_a, ends_b = (np.cumsum(t.sizes[i]) for t, i in zip(pair.both, (ids_a, ids_b)))
    # Texts follow each other; every text ends at a common end of its own.
    cut_a, cut_b = common_ends(ends_a, ends_b)
    stop_a, stop_b = np.cumsum(tokens[:, 0]), np.cumsum(tokens[:, 1])
    stop = np.searchsorted(cut_a, stop_a)
    start = np.concatenate([[0], stop[:-1]])
    n_a, n_b = (len(t.spelt) for t in pair.both)
    order = _written_order(ids_a, ids_b, cut_a, cut_b, n_a, n_b)
    written = list(map(pair.written.__getitem__, order.tolist()))
    keys = (ids_a[cut_a].astype(np.int64) << 32) | ids_b[cut_b].astype(np.int64)
    digests, pairs, times = [], [], []
    text_stop = (stop_a + stop_b).tolist()
    for n, (begin, end) in enumerate(zip([0, *text_stop], text_stop)):
        digests.append(hashlib.sha256(b"".join(written[begin:end])[:-1]).hexdigest() if end > begin else "")
        found, repeats = np.unique(keys[start[n] : stop[n]], return_counts=True)
        pairs.append(found)
        times.append(repeats)
    offsets = np.cumsum([0, *map(len, pairs)])
    links = pa.StructArray.from_arrays(
        [pa.array(np.concatenate(pairs), pa.int64()), pa.array(np.concatenate(times), pa.int64())],
        names=["pair", "times"],
    )
    return {
        "n_a": pa.array(tokens[:, 0]), "n_b": pa.array(tokens[:, 1]), "n_groups": pa.array(stop - start),
        "groups_sha256": pa.array(digests, pa.string()),
        "links": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), links),
    }


_pairs: dict[tuple[str, str], _Pair] = {}


def tokenizer_pair(byte_path: str, piece_path: str) -> _Pair:
    """One pair per worker process."""
    if (byte_path, piece_path) not in _pairs:
        _pairs[byte_path, piece_path] = _Pair(byte_path, piece_path)
    return _pairs[byte_path, piece_path]


# Whole corpus

def align_texts(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, groups_sha256, links`` of every row of ``docs``.

    ``links`` holds each linked pair of ids, ``a << 32 | b``, and how often.
    """
    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_path, piece_path)
        row = TaskContext.get().partitionId() << 40
        for batch in incoming:
            sizes = np.cumsum(batch.column("size").to_numpy())
            at = 0
            while at < batch.num_rows:
                before = sizes[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(sizes, before + TEXT_AT_ONCE, side="right")))
                some = batch.slice(at, stop - at)
                made = _aligned(pair, some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + some.num_rows)), some.column("doc_id"), *made.values()],
                    names=["row", "doc_id", *made],
                )
                row += some.num_rows
                at = stop

    kept = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.length(body(text)).cast("bigint").alias("size"),
        body(text).alias("text"),
    )
    return kept.mapInArrow(batches, SCHEMA)


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, count, best``: links of every id pair in the corpus, and whether its B id
    has no pair with more."""
    counts = settle(links.groupBy("pair").agg(F.sum("times").alias("count")))
    b_id = F.col("pair").bitwiseAND((1 << 32) - 1)
    most = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))  # one row per id of B
    return settle(
        counts.withColumn("b", b_id).join(most, "b").select(
            "pair", "count", (F.col("count") == F.col("most")).alias("best")
        )
    )


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A is a byte-level BPE that sees a blank before the text, B a sentencepiece model
    that adds it; special tokens in texts are plain text. Groups lie between offsets
    at which tokens of both end; an A and a B token that end together are linked.
    ``count_sum`` adds up how often the ids of each link are linked in all of
    ``docs``; ``n_best`` counts the links whose pair is the most frequent one of its
    B id, equal ones included.

    A text that is NULL, empty or spelt with other bytes by a tokenizer has no
    tokens: zeros and an empty digest. Repeated rows, and rows with NULL or equal
    ``doc_id``, all come out and all count; other columns are not read. An empty
    table gives no rows. A long text is aligned as a whole in one task.
    """
    aligned = settle(align_texts(docs, byte_path, piece_path, text))
    links = aligned.select("row", F.explode("links").alias("link")).select("row", "link.*")
    found = lookup_join(links, pair_counts(links), "pair", "inner")
    sums = found.groupBy("row").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    none = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return aligned.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", none("n_links"), none("n_best"), none("count_sum"), "groups_sha256"
    )

"""Token-id files: documents to ids, ids to entropy-coded files, and back.

Documents are sorted by range, so the files follow ascending ``doc_id``. Every
task tokenizes its documents and packs them into segments of whole documents,
whose ids are coded by ``spinneret.llm.rans``. A segment knows the number of ids
before it in its file; the sums of earlier files give the place in the whole.
"""

import os
import zlib
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spinneret.llm import rans
from spinneret.llm.columns import body, text_key

END_ID = 2
#: A segment is closed at so many ids; a chunk of one never holds more.
SEGMENT = 1 << 21
#: Texts are encoded so many at once, or fewer with so many bytes.
DOCUMENTS_AT_ONCE = 1000
BYTES_AT_ONCE = 1 << 22
KNOWN_PIECES = 400_000
LONGEST_KNOWN = 40
PIECES_AT_ONCE = 200

SEGMENT_SCHEMA = (
    "part int, segment int, first bigint, n_tokens bigint, doc_ids array<bigint>, "
    "lengths array<bigint>, chunks array<binary>"
)
DOCUMENT_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

#: White space that the pre-tokenizer would join with a blank or line break next to it.
BLANK = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
JOINED_BLANKS = rf"[ \n](?:{BLANK}|$)|^{BLANK}"
PUNCTUATION = frozenset(punctuation)


def _strings(texts: pa.Array) -> list[str]:
    """``to_pylist`` of texts without NULL, without a scalar for each."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class PieceEncoder:
    """The tokenizer with a memory for pieces between single blanks and line breaks.

    A byte-level tokenizer splits a text before each blank, around each line break and
    between a letter or digit and ASCII punctuation, so such pieces can be encoded apart.
    Texts with other runs of white space or with special tokens are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        # Bytes of each id: a token is spelt with one letter for each byte.
        sizes = {i: len(t) for t, i in self.tokenizer.get_vocab().items()}
        self.sizes = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)], dtype=np.int64)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Many pieces, each behind its blank or line break, encoded as one text and cut apart."""
        if not pieces:
            return []
        spelt = [p if p[0] == "\n" else " " + p for p in pieces]
        runs = [spelt[i : i + PIECES_AT_ONCE] for i in range(0, len(spelt), PIECES_AT_ONCE)]
        data = b"".join(self._encode(["".join(run) for run in runs]))
        ends = np.cumsum(self.sizes[np.frombuffer(data, dtype="<u4")])
        wanted = np.cumsum([len(p.encode()) for p in spelt])
        cuts = np.searchsorted(ends, wanted)
        if (ends[cuts] != wanted).any():
            raise ValueError("this tokenizer does not split at blanks and line breaks")
        bounds = [0, *(4 * (cuts + 1)).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learn(self, pieces: list[str]) -> None:
        """Add pieces to the memory: a word and the punctuation behind it by themselves."""
        known = self.known
        cores, parts = set(), []
        for piece in pieces:
            if piece[-1] in PUNCTUATION:
                core = piece.rstrip(punctuation)
                if core and (core[-1].isalpha() or core[-1].isdecimal()):
                    parts.append((piece, core, piece[len(core) :]))
                    if core not in known:
                        cores.add(core)
                    continue
            cores.add(piece)
        fresh = list(cores)
        known.update(zip(fresh, self._encode_pieces(fresh)))
        tails = list({tail for _, _, tail in parts} - self.tails.keys())
        self.tails.update(zip(tails, self._encode(tails)))
        for piece, core, tail in parts:
            known[piece] = known[core] + self.tails[tail]

    def _coded(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces; what is new among them is learnt."""
        coded = list(map(self.known.get, pieces))
        fresh = [i for i, ids in enumerate(coded) if ids is None]
        if len(self.known) + len(fresh) > KNOWN_PIECES + len(pieces):
            self.known, self.tails = {}, {}
            fresh = range(len(pieces))
        self._learn([pieces[i] for i in fresh])
        for i in fresh:
            piece = pieces[i]
            coded[i] = self.known[piece]
            if len(piece) > LONGEST_KNOWN:
                del self.known[piece]
        return coded

    def _separable(self, texts: pa.Array) -> pa.Array:
        blanks = pc.match_substring_regex(texts, JOINED_BLANKS)
        for special in self.special:
            blanks = pc.or_(blanks, pc.match_substring(texts, special))
        return pc.invert(pc.or_(blanks, pc.equal(pc.binary_length(texts), 0)))

    def _encode_apart(self, texts: pa.Array) -> list[bytes]:
        """Ids of separable texts: each different piece once, put together by their places."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        heads = self._encode(_strings(pc.list_element(split, 0)))
        rest = pc.list_slice(split, 1)
        bounds = rest.offsets.to_numpy()
        pieces = rest.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        coded = self._coded(_strings(pieces.dictionary))
        flat = np.frombuffer(b"".join(coded), dtype="<u4")
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        which = pieces.indices.to_numpy()
        lengths = sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        moved = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        ids = flat[np.arange(ends[-1]) + np.repeat(moved, lengths)]
        cuts = ends[bounds - bounds[0]].tolist()
        return [head + ids[a:b].tobytes() for head, a, b in zip(heads, cuts, cuts[1:])]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of every text, without an end id, as little-endian unsigned 32-bit integers."""
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        apart = self._separable(column)
        pieced = iter(self._encode_apart(column.filter(apart)))
        whole = iter(self._encode(_strings(column.filter(pc.invert(apart)))))
        return [next(pieced if a else whole) for a in apart.to_pylist()]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _segment(part: int, number: int, first: int, ids: list[int], data: list[bytes]) -> pa.RecordBatch:
    stream = np.frombuffer(b"".join(data), dtype="<u4")
    chunks = [rans.encode(stream[i : i + SEGMENT]) for i in range(0, len(stream), SEGMENT)]
    lengths = [len(d) // 4 for d in data]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()), pa.array([number], pa.int32()),
            pa.array([first], pa.int64()), pa.array([len(stream)], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
            pa.array([chunks], pa.list_(pa.binary())),
        ],
        names=["part", "segment", "first", "n_tokens", "doc_ids", "lengths", "chunks"],
    )


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of at most ``DOCUMENTS_AT_ONCE`` rows that begin within the same
    ``BYTES_AT_ONCE`` of text."""
    sizes = pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // BYTES_AT_ONCE
    edges = np.union1d(np.flatnonzero(np.diff(group)) + 1, np.arange(0, len(group) + 1, DOCUMENTS_AT_ONCE))
    cuts = np.union1d(edges, [0, len(group)]).tolist()
    for at, end in zip(cuts, cuts[1:]):
        yield batch.slice(at, end - at)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    end = np.array([end_id], dtype="<u4").tobytes()
    number = first = size = 0
    ids: list[int] = []
    data: list[bytes] = []
    for batch in batches:
        for some in _slices(batch):
            coded = encoder(path).encode(some.column("text"))
            for doc_id, document in zip(some.column("doc_id").to_pylist(), coded):
                ids.append(doc_id)
                data.append(document + end)
                size += len(document) // 4 + 1
                if size >= SEGMENT:
                    yield _segment(part, number, first, ids, data)
                    number, first, size, ids, data = number + 1, first + size, 0, [], []
    if ids:
        yield _segment(part, number, first, ids, data)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, text: str = "text"
) -> None:
    """Write the ids of every row of ``docs``, in ascending ``doc_id`` order, to ``path``.

    NULL ids come first; rows with equal ids are ordered by a hash of their text,
    and repeated rows are all written. A NULL text is an empty one, which still
    has its end id. Other columns are not written.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(text).alias("key"), body(text).alias("text"))
        .repartitionByRange("doc_id", "key")
        .sortWithinPartitions("doc_id", "key")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(lambda b: _encoded(b, tokenizer, end_id), SEGMENT_SCHEMA).write.parquet(
        path, compression="none"
    )


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row]  # noqa: B023, E731
            lengths = np.asarray(get("lengths").as_py(), dtype=np.int64)
            ends = np.cumsum(lengths)
            crcs = np.zeros(len(lengths), dtype=np.int64)
            seen, place = 0, 0
            for chunk in get("chunks"):
                ids = rans.decode(chunk.as_py())
                # A document longer than a chunk goes on in the next one.
                while place < len(ends):
                    begin = int(max(ends[place] - lengths[place], seen))
                    stop = int(min(ends[place], seen + len(ids)))
                    crcs[place] = zlib.crc32(ids[begin - seen : stop - seen], int(crcs[place]))
                    if ends[place] > seen + len(ids):
                        break
                    place += 1
                seen += len(ids)
            start = get("offset").as_py() + get("first").as_py() + ends - lengths
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(get("doc_ids").as_py(), pa.int64()), pa.array(start, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    Only the number of ids per file, one row each, is summed in one task.
    """
    files = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.groupBy("part").agg(F.sum("n_tokens").alias("held")).select(
        "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset")
    )
    placed = files.join(F.broadcast(offsets), "part")
    return placed.select("first", "offset", "doc_ids", "lengths", "chunks").mapInArrow(
        _decoded, DOCUMENT_SCHEMA
    )

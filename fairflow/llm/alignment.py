"""Cross-tokenizer alignment: diagonal run skipping over the byte ends of two tokenizations.

A document's text is encoded by tokenizer A (byte-level BPE, one space put in front) and by B (BPE pieces
with byte fallback, which puts a space in front itself).  Byte offsets where a token of A and a token of
B both end cut the tokens into groups.

1. *Ends.*  Texts are cut at single spaces between printable characters, where both tokenizers begin a new
   token whatever stands around; the pieces are encoded once a worker and looked up.  What comes out
   equals the encoding of the whole text, and no memory grows with the longest text's tokens.
2. *Diagonals.*  While tokens match one to one, token i of A ends where token i + shift of B does.  Probes
   of 1, 2, 4, ... tokens compare the end arrays at the current shift and skip the whole stretch.
   At the first mismatch the irregular group is walked end by end until both end together, which
   gives the new shift.  Many places are worked on in step: a place starts at a document or at every
   ``LANE``-th token of A whose end a binary search finds among the ends of B.
3. *Links.*  Token pairs whose byte ranges overlap are the steps of that walk.  A batch of documents
   counts, per pair of ids, its documents and sends one row a pair; Spark adds these up, finds each A id's
   highest count and sends the counts back to the batches that hold the pair.

Defined results.  NULL and empty texts, texts that are not UTF-8, and texts whose tokens do not give back their bytes (those with
U+2581) have no tokens: zeros and an empty digest.  Repeated rows are documents of their own and count each.
Ids are passed on as they are, NULL too; other columns are ignored.  Without documents there are no rows.
The folder of the tokenizer files is a parameter; every executor must have it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import pack, pack_sorted, unpack, unpack_sorted
from .register import query
from .staging import staged

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
LANE = 128
WIDEST = 4096
CHUNK = 1 << 18
BLOCK_CHARS = 1 << 20
BATCH_PAIRS = 1 << 20
CACHED_CHARS = 1 << 25
BITS = 20

# A single space between two characters that are surely no white space.
_CUT = re.compile(r" (?<=[!-~\w] )(?=[!-~\w])")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class _Numbers(dict):
    """Piece of text -> number; a new piece waits in ``new`` to be encoded."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


class _Ragged:
    """Lists of token ids, end to end."""

    def __init__(self) -> None:
        self.flat, self.first, self.used, self.rows = np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0, 0

    def extend(self, lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        total, rows = self.used + int(sizes.sum()), self.rows + len(lists)
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(total, np.int32)])
        if rows >= len(self.first):
            self.first = np.concatenate([self.first, np.zeros(rows, np.int64)])
        self.flat[self.used:total] = np.fromiter((t for x in lists for t in x), np.int32, total - self.used)
        self.first[self.rows + 1:rows + 1] = self.used + np.cumsum(sizes)
        self.used, self.rows = total, rows

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self.first[rows + 1] - self.first[rows]

    def take(self, rows: np.ndarray) -> np.ndarray:
        sizes = self.sizes(rows)
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.first[rows] - before, sizes) + np.arange(int(sizes.sum()))]


class Tokenizers:
    """Both tokenizers of a worker, and the pieces of text encoded so far (bounded)."""

    def __init__(self, folder: str, a_file: str, b_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        path = f"{folder}/{a_file}"
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{b_file}")
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            known = all(c in letters for c in token)
            self.a_bytes[k] = bytes(letters[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()
                        for k, p in enumerate(pieces)]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << BITS:
            raise ValueError(f"token ids need more than {BITS} bits")
        self.a_length, self.b_length = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # Texts may be cut only if no token of either reaches over the cut.
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        before = made["pre_tokenizer"] or {}
        self.cuts = made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not any(
            "▁" in p.lstrip("▁") for p in pieces)
        # "id," or, at the end of a group, "id|" and "id;"
        self.a_said = np.array([f"{k}{end}" for k in range(len(self.a_bytes)) for end in ",|"], object)
        self.b_said = np.array([f"{k}{end}" for k in range(len(self.b_bytes)) for end in ",;"], object)
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.chars = _Numbers(), 0
        self.a_ids, self.b_ids, self.whole = _Ragged(), _Ragged(), np.empty(0, bool)

    def make_room(self) -> None:
        """Called between blocks: forget the pieces when they take too much room."""
        if self.chars > CACHED_CHARS:
            self._forget()

    def chunks(self, text: str) -> Iterator[str]:
        """The text in parts of about ``CHUNK`` characters; the space between two parts belongs to the second."""
        at = 0
        while self.cuts and len(text) - at > CHUNK:
            cut = _CUT.search(text, at + CHUNK)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.end()
        yield text[at:] if at else text

    def pieces(self, chunk: str) -> np.ndarray:
        """Numbers of the pieces of a chunk; each piece has a space in front, which is not part of its key."""
        parts = _CUT.split(chunk) if self.cuts else [chunk]
        return np.fromiter(map(self.numbers.__getitem__, parts), np.int64, len(parts))

    def encode_new(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        for first in range(0, len(new), 4096):
            some = new[first:first + 4096]
            a = [x.ids for x in self.a.encode_batch([f" {t}" for t in some], add_special_tokens=False)]
            b = self.b.encode(some, num_threads=1)
            self.a_ids.extend(a)
            self.b_ids.extend(b)
            whole = []
            for text, x, y in zip(some, a, b):
                wanted = f" {text}".encode()
                whole.append(wanted == b"".join([self.a_bytes[k] for k in x]) == b"".join([self.b_bytes[k] for k in y]))
                self.chars += len(text) + 64
            self.whole = np.concatenate([self.whole, np.array(whole, bool)])


@lru_cache(maxsize=2)
def tokenizers(folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> Tokenizers:
    return Tokenizers(folder, a_file, b_file)


def skip_diagonals(ends_a: np.ndarray, ends_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray):
    """(common ends of A, of B, linked tokens of A, of B) by diagonal run skipping.

    Both tokenizations cover the same bytes; before ``starts_a[k]`` and ``starts_b[k]`` both ended together.
    """
    last_a, last_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    if not len(ends_a):
        nothing = np.empty(0, np.int64)
        return last_a, last_b, nothing, nothing
    sampled = np.arange(LANE - 1, len(ends_a) - 1, LANE)
    found = np.searchsorted(ends_b, ends_a[sampled])
    both = ends_b[found] == ends_a[sampled]
    i, kept = np.unique(np.concatenate([starts_a, sampled[both] + 1]), return_index=True)
    j = np.concatenate([starts_b, found[both] + 1])[kept]
    stop_i, stop_j = np.append(i[1:], len(ends_a)), np.append(j[1:], len(ends_b))
    width = np.ones(len(i), np.int64)
    links_a, links_b = [], []
    while len(i):
        # A probe of the stretch ahead at the present shift j - i.
        width = np.minimum(np.minimum(width, stop_i - i), stop_j - j)
        begin = np.cumsum(width) - width
        step = np.arange(int(width.sum())) - np.repeat(begin, width)
        p, q = np.repeat(i, width) + step, np.repeat(j, width) + step
        same = ends_a[p] == ends_b[q]
        run = np.minimum.reduceat(np.where(same, WIDEST + 1, step), begin)
        run = np.minimum(run, width)
        inside = step < np.repeat(run, width)
        p, q = p[inside], q[inside]
        last_a[p] = last_b[q] = True
        links_a.append(p)
        links_b.append(q)
        i, j = i + run, j + run
        met = run == width
        width = np.where(met, np.minimum(2 * width, WIDEST), 1)
        # An irregular group is walked until both end together.
        at = np.flatnonzero(~met)
        p, q = i[at], j[at]
        while len(at):
            links_a.append(p)
            links_b.append(q)
            x, y = ends_a[p], ends_b[q]
            done = x == y
            last_a[p[done]] = last_b[q[done]] = True
            i[at[done]], j[at[done]] = p[done] + 1, q[done] + 1
            p, q = (p + (x < y))[~done], (q + (y < x))[~done]
            at = at[~done]
        going = i < stop_i
        if not going.all():
            i, j, stop_i, stop_j, width = i[going], j[going], stop_i[going], stop_j[going], width[going]
    return last_a, last_b, np.concatenate(links_a), np.concatenate(links_b)


class _Aligned:
    """A block of chunks of documents, aligned."""

    def __init__(self, vocabulary: Tokenizers, chunks: list[np.ndarray]) -> None:
        pieces = np.concatenate(chunks)
        edges = np.cumsum([0] + [len(c) for c in chunks])
        self.vocabulary = vocabulary
        self.a, self.b = vocabulary.a_ids.take(pieces), vocabulary.b_ids.take(pieces)

        def first_of(ids: _Ragged) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(ids.sizes(pieces))])[edges]

        self.first_a, self.first_b = first_of(vocabulary.a_ids), first_of(vocabulary.b_ids)
        ends_a, ends_b = np.cumsum(vocabulary.a_length[self.a]), np.cumsum(vocabulary.b_length[self.b])
        self.last_a, self.last_b, self.link_a, self.link_b = skip_diagonals(
            ends_a, ends_b, self.first_a[:-1], self.first_b[:-1])

    def said(self) -> list[str]:
        """The groups of each chunk as text: ``a1,a2|b1;a3|b2,b3;``."""
        groups_a, groups_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        ends_a = np.flatnonzero(self.last_a)
        begins_b = np.concatenate([[0], np.flatnonzero(self.last_b) + 1])
        words = np.empty(len(self.a) + len(self.b), object)
        words[np.arange(len(self.a)) + begins_b[groups_a]] = self.vocabulary.a_said[2 * self.a + self.last_a]
        words[np.arange(len(self.b)) + ends_a[groups_b] + 1] = self.vocabulary.b_said[2 * self.b + self.last_b]
        edges = (self.first_a + self.first_b).tolist()
        return ["".join(words[x:y].tolist()) for x, y in zip(edges[:-1], edges[1:])]

    def groups(self) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(self.last_a)])[self.first_a])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of each chunk with their number of links, where each chunk's begin, and its links."""
        chunk = np.searchsorted(self.first_a, self.link_a, "right") - 1
        links = np.bincount(chunk, minlength=len(self.first_a) - 1)
        code = (self.a[self.link_a].astype(np.int64) << BITS) | self.b[self.link_b]
        order = np.lexsort((code, chunk)) if len(links) >= 1 << (63 - 2 * BITS) else None
        if order is None:
            both = np.sort((chunk << (2 * BITS)) | code)
            chunk, code = both >> (2 * BITS), both & ((1 << 2 * BITS) - 1)
        else:
            chunk, code = chunk[order], code[order]
        new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (chunk[1:] != chunk[:-1])])) if len(code) else np.empty(0, np.int64)
        times = np.diff(new, append=len(code))
        return code[new], times, np.searchsorted(chunk[new], np.arange(len(links) + 1)), links


class _Document:
    __slots__ = ("id", "n_a", "n_b", "n_groups", "n_links", "digest", "codes", "times")

    def __init__(self, id_) -> None:
        self.id, self.n_a, self.n_b, self.n_groups, self.n_links, self.digest = id_, 0, 0, 0, 0, None
        self.codes, self.times = [], []

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) == 1:
            return self.codes[0], self.times[0]
        if not self.codes:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        codes, at = np.unique(np.concatenate(self.codes), return_inverse=True)
        return codes, np.bincount(at, weights=np.concatenate(self.times)).astype(np.int64)


def _text_of(raw: bytes | None) -> str:
    try:
        return (raw or b"").decode()
    except UnicodeDecodeError:
        return ""


def _align(files: tuple[str, str, str], id_type: pa.DataType):
    """One row per batch of documents: what is counted of each, its pairs, and the pairs of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = tokenizers(*files)
        number = TaskContext.get().partitionId() << 32
        documents: list[_Document] = []
        block: list[tuple[_Document, np.ndarray]] = []
        chars = held = 0

        def close() -> int:
            """Align the chunks that wait; the number of pairs they add."""
            vocabulary.encode_new()
            waiting = [(d, c) for d, c in block if vocabulary.whole[c].all()]
            block.clear()
            if not waiting:
                vocabulary.make_room()
                return 0
            aligned = _Aligned(vocabulary, [c for _, c in waiting])
            codes, times, first, links = aligned.pairs()
            n_a, n_b = np.diff(aligned.first_a).tolist(), np.diff(aligned.first_b).tolist()
            groups, links = aligned.groups().tolist(), links.tolist()
            for k, ((document, _), said) in enumerate(zip(waiting, aligned.said())):
                document.n_a += n_a[k]
                document.n_b += n_b[k]
                document.n_groups += groups[k]
                document.n_links += links[k]
                if document.digest is None:
                    document.digest = hashlib.sha256()
                else:
                    document.digest.update(b";")
                document.digest.update(said[:-1].encode())
                document.codes.append(codes[first[k]:first[k + 1]])
                document.times.append(times[first[k]:first[k + 1]])
            vocabulary.make_room()
            return len(codes)

        def flush() -> pa.RecordBatch:
            pairs = [d.pairs() for d in documents]
            codes = np.concatenate([c for c, _ in pairs])
            distinct, at = np.unique(codes, return_inverse=True)
            rows = {
                "batch": pa.array([number], pa.int64()),
                "ids": pa.array([[d.id for d in documents]], pa.list_(id_type)),
                **{c: pa.array([[getattr(d, c) for d in documents]], pa.list_(pa.int64()))
                   for c in ("n_a", "n_b", "n_groups", "n_links")},
                "digests": pa.array([[d.digest.hexdigest() if d.digest else "" for d in documents]], pa.list_(pa.string())),
                "first": pa.array([pack_sorted(np.cumsum([0] + [len(c) for c, _ in pairs]).astype(np.uint64))], pa.binary()),
                "at": pa.array([pack(at)], pa.binary()),
                "times": pa.array([pack(np.concatenate([t for _, t in pairs]))], pa.binary()),
                "pairs": pa.array([pack_sorted(distinct.astype(np.uint64))], pa.binary()),
                "docs": pa.array([pack(np.bincount(at, minlength=len(distinct)))], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(rows.values()), list(rows))

        for batch in batches:
            ids, texts = batch.column("_id"), batch.column("text")
            for k in range(len(batch)):
                document = _Document(ids[k].as_py())
                documents.append(document)
                text = _text_of(texts[k].as_py())
                if text:
                    parts = list(vocabulary.chunks(text))
                    if len(parts) > 1 and not _all_whole(vocabulary, parts):
                        parts = []
                    for part in parts:
                        block.append((document, vocabulary.pieces(part)))
                        chars += len(part) + 1
                        if chars >= BLOCK_CHARS:
                            held, chars = held + close(), 0
                if held >= BATCH_PAIRS or len(documents) >= 1 << 16:
                    if block:
                        close()
                    yield flush()
                    documents, held, chars, number = [], 0, 0, number + 1
        if documents:
            if block:
                close()
            yield flush()

    return run


def _all_whole(vocabulary: Tokenizers, parts: list[str]) -> bool:
    """Whether the tokens of every part of a long text give back its bytes."""
    for part in parts:
        numbers = vocabulary.pieces(part)
        vocabulary.encode_new()
        if not vocabulary.whole[numbers].all():
            return False
    return True


def _unpack_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("batch", "pairs", "docs"))):
            codes = unpack_sorted(pairs).view(np.int64)
            for k in range(0, len(codes), 1 << 16):
                part = codes[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), number)), pa.array(part),
                     pa.array(unpack(docs)[k:k + len(part)].view(np.int64))], ["batch", "pair", "docs"])


def aligned_batches(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
                    a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Documents in batches, tokenized and aligned once and written; what the other functions start from."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = documents.select(F.col(f"`{id_col}`")).schema[0].dataType
    rows = documents.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return staged(rows.mapInArrow(
        _align((folder, a_file, b_file), to_arrow_type(kind)),
        f"batch long, ids array<{kind.simpleString()}>, n_a array<long>, n_b array<long>, n_groups array<long>,"
        " n_links array<long>, digests array<string>, first binary, at binary, times binary, pairs binary, docs binary"))


def pair_counts(batches: DataFrame) -> DataFrame:
    """pair, a, b, docs (documents that hold the pair linked) and best (none of its A id has more)."""
    rows = batches.select("batch", "pairs", "docs").mapInArrow(_unpack_pairs, "batch long, pair long, docs long")
    counts = rows.groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = staged(counts.withColumn("a", F.shiftrightunsigned("pair", BITS)))
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))
    return counts.join(highest, "a").select(
        "pair", "a", F.col("pair").bitwiseAND((1 << BITS) - 1).alias("b"), "docs", (F.col("docs") == F.col("highest")).alias("best"))


def _look_up(id_type: pa.DataType):
    """What a batch's documents sum up to, given the counts of its pairs."""
    columns = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batch: pa.Table, counts: pa.Table) -> pa.Table:
        row = {c: batch.column(c)[0].as_py() for c in ("first", "at", "times")}
        order = np.argsort(counts.column("pair").to_numpy())
        docs, best = (counts.column(c).to_numpy()[order] for c in ("docs", "best"))
        at, times = unpack(row["at"]).astype(np.int64), unpack(row["times"]).astype(np.int64)
        first = unpack_sorted(row["first"]).astype(np.int64)

        def per_document(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(values)])[first])

        nothing = np.zeros(len(first) - 1, np.int64)
        sums = per_document(times * docs[at]) if len(at) else nothing
        n_best = per_document(times * best[at]) if len(at) else nothing
        flat = {c: batch.column(c).combine_chunks().flatten() for c in ("ids", *columns, "digests")}
        return pa.table({"_id": flat["ids"].cast(id_type), **{c: flat[c] for c in columns},
                         "n_best": pa.array(n_best.astype(np.int64)), "count_sum": pa.array(sums), "groups_sha256": flat["digests"]})

    return run


def alignment_summary(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **files) -> DataFrame:
    """Per document its tokens, groups and links, how its links rank in the corpus, and a digest of its groups."""
    from pyspark.sql.pandas.types import to_arrow_type

    batches = aligned_batches(documents, id_col, text_col, **files)
    counts = staged(pair_counts(batches).select("pair", "docs", "best"))
    held = batches.select("batch", "pairs", "docs").mapInArrow(_unpack_pairs, "batch long, pair long, docs long")
    looked = held.select("batch", "pair").join(counts, "pair")
    kind = batches.schema["ids"].dataType.elementType
    rows = batches.drop("pairs", "docs").groupBy("batch").cogroup(looked.groupBy("batch")).applyInArrow(
        _look_up(to_arrow_type(kind)),
        f"_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
        " groups_sha256 string")
    return rows.withColumnRenamed("_id", id_col)


def _tokens(files: tuple[str, str, str], id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = tokenizers(*files)
        for batch in batches:
            for k in range(len(batch)):
                text = _text_of(batch.column("text")[k].as_py())
                parts: list[list] = [[], [], [], []]
                chunks = list(vocabulary.chunks(text)) if text else []
                for chunk in chunks if _all_whole(vocabulary, chunks) else []:
                    pieces = vocabulary.pieces(chunk)
                    vocabulary.encode_new()
                    aligned = _Aligned(vocabulary, [pieces])
                    for held, ids, last in ((0, aligned.a, aligned.last_a), (1, aligned.b, aligned.last_b)):
                        before = sum(map(len, parts[held]))
                        parts[held].append(ids)
                        parts[held + 2].append(np.flatnonzero(last) + 1 + before)
                vocabulary.make_room()
                row = [np.concatenate(x) if x else [] for x in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("_id")[k].as_py()], id_type), *(pa.array([x], pa.list_(pa.int32())) for x in row)],
                    ["_id", "a", "b", "a_ends", "b_ends"])
    return run


def alignments(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
               a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """The alignment itself: per document the ids ``a`` and ``b``; group g holds the tokens up to, not with,
    ``a_ends[g]`` and ``b_ends[g]`` that no group before it holds."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = documents.select(F.col(f"`{id_col}`")).schema[0].dataType
    rows = documents.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(
        _tokens((folder, a_file, b_file), to_arrow_type(kind)),
        f"_id {kind.simpleString()}, a array<int>, b array<int>, a_ends array<int>, b_ends array<int>",
    ).withColumnRenamed("_id", id_col)


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_summary(spark.read.parquet(f"{sf_dir}/documents.parquet"))

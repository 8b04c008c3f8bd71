"""Byte-level BPE over a table of distinct words.

Spark splits texts into words.  A block of documents keeps its words as numbers into a
dictionary of its own; the dictionaries' words meet in one table, in which each distinct
word is encoded once.  The ids then go back to the blocks, whose documents put them in
place by position, and meet their pieces in a join with the vocabulary, which is small
enough for every task to have whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import col, give_back, ship, tidy

ship(__name__)

#: The vocabulary's own split pattern, white space as Unicode has it, and most frequent cases first.
PATTERN = (
    r" ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\p{IsWhite_Space}\p{L}\p{N}]++"
    r"|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
)
#: Bytes of text in a block; a longer document is a block by itself.
BLOCK_BYTES = 32 << 20
#: Words whose codes are packed together.
CHUNK_WORDS = 1 << 16
#: Rows that a task gathers before it packs them by block.
PACK_ROWS = 1 << 19
#: A vocabulary of up to so many pieces is broadcast, a larger one is joined by shuffle.
BROADCAST_PIECES = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_tokenizer(path: str | None) -> str:
    """The tokenizer's JSON; the driver reads it and sends it along (a few MB, as large as the vocabulary)."""
    with open(path or default_tokenizer(), encoding="utf-8") as file:
        return file.read()


@functools.cache
def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


def _special(spec: str) -> dict[str, int]:
    return {t["content"]: t["id"] for t in json.loads(spec)["added_tokens"]}


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(spec: str) -> dict[int, bytes]:
    """The bytes of every id."""
    table, special = byte_of_char(), _special(spec)
    found = {i: p for p, i in json.loads(spec)["model"]["vocab"].items()} | {i: p for p, i in special.items()}

    def plain(piece: str) -> bytes:
        if piece in special or any(c not in table for c in piece):
            return piece.encode()
        return bytes(table[c] for c in piece)

    return {i: plain(p) for i, p in sorted(found.items())}


def vocabulary(spark: SparkSession, spec: str) -> DataFrame:
    """(id, piece) with the bytes of every id as hex."""
    rows = [(i, p.hex()) for i, p in pieces(spec).items()]
    frame = spark.createDataFrame(rows, "id int, piece string")
    return F.broadcast(frame) if len(rows) <= BROADCAST_PIECES else frame


def _split_by_library(spec: str, text: str) -> list[str]:
    """Words as the library splits them: special tokens first, then each stretch between."""
    tokenizer, found, rest = _tokenizer(spec), [], text
    special = sorted(_special(spec), key=len, reverse=True)
    while rest:
        at, token = min(((rest.find(s), s) for s in special if s in rest), default=(len(rest), ""), key=lambda x: x[0])
        if at:
            found += [rest[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(rest[:at])]
        if token:
            found.append(token)
        rest = rest[at + len(token) :]
    return found


def _with_words(docs: DataFrame, id: str, text: str, spec: str) -> DataFrame:
    """(id, text, words) in a settled order within partitions; a null text is empty.

    ``words`` is null where the library has to split: at special tokens, and at
    characters newer than the Unicode version of the JVM.
    """
    own = F.coalesce(col(text), F.lit(""))
    rows = docs.select(col(id).alias("id"), own.alias("text"))
    odd = F.col("text").rlike(r"\p{Cn}")
    for token in _special(spec):
        odd |= F.contains("text", F.lit(token))
    words = F.when(~F.col("odd"), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    return rows.withColumn("odd", odd).sortWithinPartitions("id", F.xxhash64("text")).select(
        "id", F.octet_length("text").alias("size"), F.when(F.col("odd"), F.col("text")).alias("text"), words.alias("words")
    )


def _blocks(batches, spec: str):
    """Per block: its number, document ids, words per document, word codes, and the dictionary.

    The number is a hash of all the block holds, so that both sides of the later join
    have the same number only for the same content.
    """
    import xxhash

    ids, counts, parts, size = [], [], [], 0

    def block():
        flat = pa.chunked_array(parts, pa.string()).combine_chunks()
        coded = flat.dictionary_encode() if len(flat) else pa.array([], pa.string()).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        often = np.bincount(codes, minlength=len(coded.dictionary))
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        words, codes = coded.dictionary.take(pa.array(order)), rank[codes]
        docs = pa.concat_arrays(ids)
        mark = xxhash.xxh64(codes.tobytes())
        mark.update("\x00".join(words.to_pylist()).encode("utf-8", "surrogatepass"))
        mark.update("\x00".join(map(str, docs.to_pylist())).encode("utf-8", "surrogatepass"))
        number = int(np.array([mark.intdigest()], np.uint64).view(np.int64)[0])
        return number, docs, np.concatenate(counts), codes, words

    for batch in batches:
        sizes = batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
        since = 0
        while since < batch.num_rows:
            room = np.searchsorted(np.cumsum(sizes[since:]), BLOCK_BYTES - size, side="right")
            until = min(batch.num_rows, since + max(int(room), 0 if ids else 1))
            if until > since:
                piece = batch.slice(since, until - since)
                words = piece.column("words")
                if words.null_count:
                    texts = piece.column("text").to_pylist()
                    full = [w if t is None else _split_by_library(spec, t) for w, t in zip(words.to_pylist(), texts)]
                    words = pa.array(full, pa.list_(pa.string()))
                ids.append(piece.column("id"))
                counts.append(np.diff(words.offsets.to_numpy()))
                parts.append(words.flatten())
                size += int(sizes[since:until].sum())
                since = until
            if since < batch.num_rows:
                yield block()
                ids, counts, parts, size = [], [], [], 0
    if ids:
        yield block()


def _word_rows(batches, spec: str):
    for number, _, _, _, words in _blocks(batches, spec):
        codes = np.arange(len(words), dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(words), number, np.int64)), pa.array(codes), words], ["block", "code", "word"]
        )


def _planes(codes: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes: the higher bytes of small numbers cost next to nothing."""
    raw = codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.Codec("zstd", compression_level=5).compress(raw, asbytes=True)


def _codes(planes: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(planes, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view(np.int32).ravel()


def _doc_rows(batches, spec: str):
    """Neighbouring documents of a block in one row: ids, words of each, codes of all."""
    for number, docs, counts, codes, _ in _blocks(batches, spec):
        ends = np.cumsum(counts)
        first = 0
        while first < len(docs):
            before = int(ends[first] - counts[first])
            until = max(first + 1, int(np.searchsorted(ends, before + CHUNK_WORDS, side="right")))
            part = codes[before : int(ends[until - 1])]
            size = until - first
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), docs[first:until]),
                    pa.array([counts[first:until].astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([_planes(part)], pa.binary()),
                ],
                ["block", "id", "n", "codes"],
            )
            first = until


PACK = "block long, n int, n_ids int, steps binary, lengths binary, ids binary"


def _packs(batches):
    """Rows (code, ids) of a block in one row: steps from code to code, lengths, and ids, each packed."""
    waiting, rows = [], 0

    def packed():
        table = pa.Table.from_batches(waiting)
        order = np.lexsort([table["code"].to_numpy(), table["block"].to_numpy()])
        blocks, codes = table["block"].to_numpy()[order], table["code"].to_numpy()[order]
        ids = table["ids"].take(pa.array(order)).combine_chunks()
        ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1] // 4
        flat = np.frombuffer(ids.buffers()[2], "<i4") if ends[-1] else np.zeros(0, "<i4")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]]).tolist()
        out = {"block": [], "n": [], "n_ids": [], "steps": [], "lengths": [], "ids": []}
        for a, b in zip(cuts, cuts[1:]):
            out["block"].append(int(blocks[a]))
            out["n"].append(b - a)
            out["n_ids"].append(int(ends[b] - ends[a]))
            out["steps"].append(_planes(np.diff(codes[a:b], prepend=0)))
            out["lengths"].append(_planes(np.diff(ends[a : b + 1])))
            out["ids"].append(_planes(flat[ends[a] : ends[b]]))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= PACK_ROWS:
            yield packed()
            waiting, rows = [], 0
    if rows:
        yield packed()


@functools.cache
def _spelled(spec: str) -> tuple[list[str], list[bytes]]:
    """Every id as text, and its bytes."""
    found = pieces(spec)
    return [str(i) for i in range(max(found) + 1)], [found.get(i, b"") for i in range(max(found) + 1)]


def _put_in_place(docs: pa.Table, packs: pa.Table, spec: str, lists: bool, decoded: bool) -> pa.Table:
    """Ids and decoded bytes of a block's documents."""
    number, piece = _spelled(spec)
    known, lengths, flats = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for n, n_ids, steps, sizes, ids in zip(*(packs[c].to_pylist() for c in ("n", "n_ids", "steps", "lengths", "ids"))):
        known.append(np.cumsum(_codes(steps, n)))
        lengths.append(_codes(sizes, n))
        flats.append(_codes(ids, n_ids))
    known, lengths, flat = np.concatenate(known), np.concatenate(lengths).astype(np.int64), np.concatenate(flats)
    starts = np.cumsum(lengths) - lengths
    # Blocks with the same rows have one number and one dictionary, which comes once for each.
    known, first = np.unique(known, return_index=True)
    if not np.array_equal(known, np.arange(len(known))):
        raise RuntimeError("a block's words are not all there")
    lengths, starts = lengths[first], starts[first]
    each = [flat[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist())]
    as_text = [",".join([number[i] for i in e.tolist()]) for e in each]
    as_bytes = [b"".join([piece[i] for i in e.tolist()]) for e in each]
    out = {"id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
    out |= {"ids": []} if lists else {}
    out |= {"decoded": []} if decoded else {}
    for names, counts, planes in zip(*(docs[c].combine_chunks() for c in ("id", "n", "codes"))):
        out["id"].append(names.values)
        counts = counts.values.to_numpy()
        codes = _codes(planes.as_py(), int(counts.sum()))
        if len(codes) and int(codes.max()) >= len(each):
            raise RuntimeError("the input's partitions changed between two reads; write it to a table first")
        for end, n in zip(np.cumsum(counts).tolist(), counts.tolist()):
            own = codes[end - n : end]
            listed = own.tolist()
            text = ",".join([as_text[c] for c in listed])
            whole = b"".join([as_bytes[c] for c in listed])
            size = lengths[own]
            out["n_tokens"].append(int(size.sum()))
            out["ids_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(whole.decode("utf-8", "replace").encode()).hexdigest())
            if lists:
                at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[own], size)
                out["ids"].append(flat[at])
            if decoded:
                out["decoded"].append(whole.decode("utf-8", "replace"))
    out["id"] = pa.chunked_array(out["id"])
    kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
    return pa.table({k: v if k == "id" else pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})


def round_trip(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    lists: bool = True,
    decoded: bool = True,
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids][, decoded]) of every row's whole text.

    Ids are those of the tokenizers library without special tokens added; special
    tokens written in a text keep their own id.  ``decoded`` is the text that the ids
    give back.  A null or empty text has no tokens.  Repeated rows come out as often as
    they came in.  ``tokenizer`` is the path of a byte-level BPE file.
    """
    spec = read_tokenizer(tokenizer)
    split = _with_words(docs, id, text, spec)
    words = split.mapInArrow(tidy(lambda b: _word_rows(b, spec)), "block long, code int, word string")
    # The join's own null test, set before the shuffle, so that the shuffle is the same on both sides.
    words = words.where("word is not null").repartition("word")

    @F.pandas_udf("binary")
    def encode(column: pd.Series) -> pd.Series:
        special, tokenizer = _special(spec), _tokenizer(spec)
        found = tokenizer.encode_batch(column.tolist(), add_special_tokens=False)
        ids = [[special[w]] if w in special else e.ids for w, e in zip(column, found)]
        return pd.Series([np.array(i, "<i4").tobytes() for i in ids])

    # The distinct words come from the same shuffle as the rows that they are joined with: both use
    # all its columns.  Called nondeterministic, the encoder stays above the aggregate.
    distinct = words.groupBy("word").agg(F.min("block").alias("b"), F.min("code").alias("c"))
    table = distinct.where("b is not null and c >= 0").select("word", encode.asNondeterministic()("word").alias("ids"))
    back = words.join(table, "word").select("block", "code", "ids").mapInArrow(tidy(_packs), PACK)
    kind = docs.select(col(id)).schema[0].dataType
    rows = split.mapInArrow(
        tidy(lambda b: _doc_rows(b, spec)),
        T.StructType()
        .add("block", "long")
        .add("id", T.ArrayType(kind))
        .add("n", T.ArrayType(T.IntegerType()))
        .add("codes", "binary"),
    )
    schema = T.StructType().add("id", kind).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    schema = schema.add("ids", T.ArrayType(T.IntegerType())) if lists else schema
    schema = schema.add("decoded", "string") if decoded else schema

    def put(a, b):
        out = _put_in_place(a, b, spec, lists, decoded)
        give_back()
        return out

    return (
        rows.groupBy("block")
        .cogroup(back.groupBy("block"))
        .applyInArrow(put, schema)
        .withColumnRenamed("id", id)
    )


def decode(tokens: DataFrame, id: str = "doc_id", ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """(id, decoded) of every row: positions joined with the pieces of their ids.

    Rows need distinct ids.  A null or empty list gives an empty text, and ids that the
    vocabulary does not have give nothing.
    """
    spec = read_tokenizer(tokenizer)
    rows = tokens.select(col(id).alias("of"), F.posexplode_outer(col(ids)).alias("at", "id"))
    joined = rows.join(vocabulary(tokens.sparkSession, spec), "id", "left")
    listed = joined.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("all"))
    return listed.select(F.col("of").alias(id), F.decode(F.unhex(F.array_join("all.piece", "")), "utf-8").alias("decoded"))

"""SentencePiece encoding and decoding by a distinct-chunk table.

SentencePiece turns spaces into markers and puts one in front of the text.  Where no piece of the
model has a marker after another character, no piece spans the start of a marker run, so a text's
ids are its chunks' ids in a row, a chunk being a marker run and what follows up to the next run.
Each task splits its texts with Arrow, encodes every distinct chunk once, and joins the ids back by
position.  The table lives in the task (at most ``TABLE`` chunks, then it starts anew), so nothing
is shuffled, collected or broadcast, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm import textbuf
from tablemill.llm.scratch import ship, shipped, short_batches

TABLE = 150_000
MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")


def _separable(model) -> bool:
    """No piece has a marker after another character, spaces are kept and one is put in front."""
    crossing = any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size()))
    return not crossing and model.decode(model.encode(" a  b ")) == " a  b " and model.encode("a b") == model.encode("a") + model.encode("b")


class _Table:
    """ids and decoded text of every distinct chunk seen; a chunk is held without its first marker."""

    def __init__(self, model):
        self.model = model
        self.bare = [model.piece_to_id(MARK)]
        self.number: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.number.clear()
        self.ids: list[list[int]] = []
        self.text: list[str] = []

    def numbers(self, chunks: list[str]) -> np.ndarray:
        if len(self.number) + len(chunks) > TABLE:
            self.clear()
        fresh = [c for c in chunks if c not in self.number]
        ids = self.model.encode(fresh, num_threads=1) if fresh else []
        ids = [i if c else self.bare for c, i in zip(fresh, ids)]
        self.number.update(zip(fresh, range(len(self.ids), len(self.ids) + len(fresh))))
        self.ids += ids
        self.text += self.model.decode(ids, num_threads=1) if ids else []
        return np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All chunks of the texts, and where each text's chunks begin."""
    parts = pc.split_pattern(texts, " ")
    begin = np.asarray(parts.offsets, dtype=np.int64)
    flat = parts.flatten()
    blank = np.concatenate([[0], np.cumsum(np.asarray(pc.equal(flat, "")))])
    odd = np.flatnonzero(blank[begin[1:]] > blank[begin[:-1]])
    if not len(odd):
        return flat, begin
    # A text with runs of spaces (or none) is cut at the runs, not at each space.
    rest, keep, count = {}, np.ones(len(flat), dtype=bool), np.diff(begin)
    for i in odd.tolist():
        text = texts[i].as_py()
        rest[i] = [c[1:] for c in _CHUNK.findall(" " + text)] if text else []
        keep[begin[i] : begin[i + 1]] = False
        count[i] = len(rest[i])
    pieces, done = [], 0
    for i in odd.tolist():
        pieces += [flat.slice(done, begin[i] - done), pa.array(rest[i], flat.type)]
        done = begin[i + 1]
    pieces.append(flat.slice(done))
    return pa.concat_arrays(pieces), np.concatenate([[0], np.cumsum(count)])


def _encoder(model: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=shipped(model))
        table = _Table(processor) if _separable(processor) else None
        for batch in batches:
            for run in textbuf.runs(batch, "text"):
                texts = pc.fill_null(run.column(1).cast(pa.large_string()), "")
                if table is None:
                    ids = processor.encode(texts.to_pylist(), num_threads=1)
                    decoded = processor.decode(ids, num_threads=1)
                    yield pa.RecordBatch.from_arrays([run.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["id", "ids", "decoded"])
                    continue
                chunks, begin = _split(pc.replace_substring(texts, MARK, " "))
                coded = chunks.dictionary_encode()
                at = table.numbers(coded.dictionary.to_pylist())
                ids = [table.ids[i] for i in at.tolist()]
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                where = np.concatenate([[0], np.cumsum(size)])
                flat = np.fromiter((x for part in ids for x in part), np.int32, int(where[-1]))
                number = np.asarray(coded.indices, dtype=np.int64)
                each = size[number]
                end = np.concatenate([[0], np.cumsum(each)])
                spread = np.repeat(where[:-1][number] - end[:-1], each) + np.arange(end[-1])
                surface = np.array([table.text[i] for i in at.tolist()], dtype=object)[number].tolist()
                lists = pa.ListArray.from_arrays(pa.array(end[begin].astype(np.int32)), pa.array(flat[spread] if len(spread) else flat))
                decoded = [" ".join(surface[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
                yield pa.RecordBatch.from_arrays([run.column(0), lists, pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    return encode


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int), decoded.

    ids are those of the library's encode() without begin and end ids or sampling, decoded is its
    decode(ids).  A null or empty text has no ids and decodes to ''.  Whole texts are encoded,
    whatever their length; a row's id may be null or repeated; other columns are ignored.
    ``model_path`` is a file of the driver's, which is sent to the executors.
    """
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _encoder(ship(docs.sparkSession, model_path)), f"id {kind}, ids array<int>, decoded string"
    )
    return out.withColumnRenamed("id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of ``encode_documents``."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op5_sentencepiece_codec(spark, sf_dir: str) -> DataFrame:
    return digests(encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model()))

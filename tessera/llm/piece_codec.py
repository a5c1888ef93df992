"""SentencePiece encoding and decoding that keeps offsets.

The text is normalised by the longest prefixes that the model's compiled
character map knows, recording the span of source bytes behind each normalised
character; pieces are merged on the normalised text and every piece is
projected back to the bytes it came from.

With the plain normaliser (no character map, spaces kept) nothing but spaces is
rewritten, so the alignment is arithmetic: the library merges, and a prefix sum
over the pieces' widths in source bytes gives all spans of a slice of documents
at once (the bytes of a character without a piece are grouped by their lead
byte). Other models and texts that hold the space mark itself go character by
character through the recorded alignment. One pass, no shuffle.

Defined results: null counts as empty; an empty text has only the end id; ids
and other columns may be null or repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.spm import BYTE, CHUNK, CONTROL, SPACE, Model
from tessera.llm.textcols import text_slices


def encode_text(model: Model, text: str):
    """(ids, begins, ends) of one text with any normaliser; offsets in source bytes."""
    normal, spans = model.normalizer(text)
    ids, begins, ends, at = [], [], [], 0
    for chunk in CHUNK.findall(normal) if model.chunked else [normal] * bool(normal):
        got, b, e = model.encode_symbols(chunk)
        ids += got
        begins += [spans[at + x][0] for x in b]
        ends += [spans[at + y - 1][1] if y > x else spans[at + x][0] for x, y in zip(b, e)]
        at += len(chunk)
    return ids, begins, ends


class PieceTables:
    """For each id: source bytes of its piece if a space is one byte, its text, and its byte if it is a high byte."""

    def __init__(self, model: Model):
        plain = [p.replace(SPACE, " ") for p in model.pieces]
        self.text, self.byte = [], np.full(len(plain), -1, np.int64)
        for i, (piece, kind) in enumerate(zip(plain, model.kinds)):
            if kind == BYTE:
                value = int(piece[3:5], 16)
                if value >= 0x80:
                    self.byte[i] = value
                piece = chr(value) if value < 0x80 else ""
            self.text.append("" if kind == CONTROL else piece)
        self.width = np.array([len(t.encode("utf-8")) for t in self.text], np.int64)


def project(tables: PieceTables, ids: np.ndarray, first: np.ndarray):
    """Begins and ends in source bytes of all pieces of texts that start at ``first`` (and the end)."""
    width = tables.width[ids]
    byte = tables.byte[ids]
    high = np.flatnonzero(byte >= 0)
    if len(high):  # the last byte of a character covers it, the others cover nothing
        value = byte[high]
        lead = np.maximum.accumulate(np.where(value >= 0xC0, np.arange(len(high)), 0))
        last = np.append((value[1:] >= 0xC0) | (high[1:] != high[:-1] + 1), True)
        width[high] = np.where(last, np.arange(len(high)) - lead + 1, 0)
    at = np.concatenate([[0], np.cumsum(width)])
    base = np.repeat(at[first[:-1]] + 1, np.diff(first))  # the space that the normaliser added has no bytes
    return np.maximum(at[:-1] - base, 0), np.maximum(at[1:] - base, 0)


def _encode_plain(lib, model: Model, tables: PieceTables, texts: list[str], with_end: bool):
    """Flat ids, begins, ends, places of the texts' first pieces, and decoded texts."""
    lists = lib.encode(texts, num_threads=1, add_eos=with_end) if texts else []
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    ids = np.fromiter((i for x in lists for i in x), np.int64, first[-1])
    begins, ends = project(tables, ids, first)
    has_bytes = np.add.reduceat(np.append(tables.byte[ids] >= 0, False), first[:-1]) * (np.diff(first) > 0) if texts else []
    text = tables.text
    decoded = [model.decode(x) if odd else "".join([text[i] for i in x])[1:] for x, odd in zip(lists, has_bytes)]
    for n, t in enumerate(texts):
        if SPACE in t:  # a mark in the source has three bytes
            got = encode_text(model, t)
            part = slice(first[n], first[n] + len(got[0]))
            begins[part], ends[part] = got[1], got[2]
            if with_end:
                begins[part.stop] = ends[part.stop] = len(t.encode("utf-8"))
    return ids, begins, ends, first, decoded


def _encoder(data: bytes, with_end: bool):
    def run(batches):
        import sentencepiece

        model = Model(data)
        lib, tables = sentencepiece.SentencePieceProcessor(model_proto=data), PieceTables(model)
        for part, texts in text_slices(batches):
            values = texts.to_pylist()
            if model.normalizer.plain:
                ids, begin, end, total, decoded = _encode_plain(lib, model, tables, values, with_end)
            else:
                rows = [encode_text(model, t) for t in values]
                if with_end:
                    rows = [(a + [model.eos], *(x + [len(t.encode("utf-8"))] for x in (b, c))) for t, (a, b, c) in zip(values, rows)]
                ids, begin, end = (np.array([x for r in rows for x in r[i]], np.int32) for i in range(3))
                total = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])])
                decoded = [model.decode(r[0]) for r in rows]
            total = pa.array(total, pa.int32())
            lists = [pa.ListArray.from_arrays(total, pa.array(x.astype(np.int32), pa.int32())) for x in (ids, begin, end)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *lists, pa.array(decoded, pa.string())],
                                             names=[*part.schema.names[:-1], "ids", "begins", "ends", "decoded"])
    return run


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_end: bool = True) -> DataFrame:
    """Per document: id, ``ids``, the source bytes [``begins``, ``ends``) of each piece, ``decoded`` text.

    The model file (a few hundred KB) is read on the driver and sent with the task.
    """
    with open(model_path, "rb") as f:
        data = f.read()
    Model(data)  # an unsupported model fails here
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _encoder(data, with_end),
        f"id {kind}, ids array<int>, begins array<int>, ends array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)

"""Token counts from a compiled tokenizer.

A BPE vocabulary is turned into a deterministic transducer over the characters
of a chunk ("spaces, then other characters"). Of the pieces that end at a place
exactly one is the last piece of the text up to there: the one that stays apart
from the last piece before it when the two are merged on their own. A state
keeps, for the places where a piece that hasn't ended yet may have begun, the
last piece before it, and a transition is annotated with the change of the number of tokens emitted
so far. States and transitions are compiled when first met and kept up to a
bound.

Chunks are independent (no piece crosses the end of one), so a block of text
maps any entry state to (tokens, exit state) by three things: the characters
before its first chunk end, the tokens between its chunk ends, and the
characters after the last. These maps compose associatively. Long texts are
cut into blocks that are counted in parallel; the maps of a text meet in one
row and are folded there, in order, in time linear in what they carry: the few
characters around each block's ends, or the whole block where a text has no
chunk end in it (no spaces).

Defined results: null counts as empty and has 0 tokens; ids may be null or
repeated; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage
from tessera.llm.spm import CHUNK, SPACE, Model
from tessera.llm.textcols import codes_of, ragged, sums, text_slices


class Transducer:
    """Counts the tokens of a chunk, character by character, without forming them."""

    def __init__(self, model: Model, max_states: int = 200_000):
        if not (model.chunked and model.normalizer.plain):
            raise ValueError("the model normalises or joins texts across spaces")
        self.model, self.max_states = model, max_states
        self.prefixes = {p[:n] for p in model.score for n in range(1, len(p))}
        self.reset()

    def reset(self) -> None:
        #: a state: (characters since that place, last piece before it, tokens up to it less those up to here)
        #: for each place where a piece that is still to end may have begun; the last one is "here"
        self.states: list = [(("", "", 0),)]
        self.number: dict = {self.states[0]: 0}
        self.moves: dict = {}
        self.apart: dict = {}

    def _apart(self, a: str, b: str) -> bool:
        """Do pieces a and b stay as they are, side by side?"""
        got = self.apart.get((a, b))
        if got is None:
            got = self.apart[a, b] = self.model.merge(list(a + b)) == [x for x in (a, b) if x]
        return got

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        places, score = self.states[state], self.model.score
        for since, last, tokens in places:
            piece = since + c
            if (not since or piece in score) and self._apart(last, piece):
                break
        else:
            raise AssertionError("no last piece")
        change = tokens + (1 if piece in score else len(piece.encode("utf-8")))
        key = (*((since + c, last, tokens - change) for since, last, tokens in places if since + c in self.prefixes),
               ("", piece, 0))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        self.moves[state, c] = to, change
        return to, change

    def count(self, chunk: str) -> int:
        """Tokens of one chunk in source form. Tables stay within their bounds also while a long chunk runs."""
        state = total = 0
        chunk = chunk.replace(" ", SPACE)
        for at in range(0, len(chunk), 4096):
            if len(self.states) > self.max_states or len(self.apart) > 2 * self.max_states:
                key = self.states[state]
                self.reset()
                state = self.number.setdefault(key, len(self.states))
                if state == len(self.states):
                    self.states.append(key)
            moves = self.moves
            for c in chunk[at:at + 4096]:
                move = moves.get((state, c))
                state, change = move if move is not None else self._compile(state, c)
                total += change
        return total


def block_map(count, text: str) -> tuple[str, int, str, bool]:
    """(head, tokens, tail, closed) of a block; a block without a chunk end is all head."""
    parts = CHUNK.findall(text)
    if len(parts) < 2:
        return text, 0, "", False
    return parts[0], sum(map(count, parts[1:-1])), parts[-1], True


def compose(count, a, b) -> tuple[str, int, str, bool]:
    """The map of two blocks one after the other."""
    head_a, tokens_a, tail_a, closed_a = a
    head_b, tokens_b, tail_b, closed_b = b
    head, tokens, tail, closed = block_map(count, (tail_a if closed_a else head_a) + head_b)
    if not closed_a and not closed_b:
        return head, tokens, tail, closed
    if not closed_a:
        return (head, tokens + count(tail) + tokens_b, tail_b, True) if closed else (head, tokens_b, tail_b, True)
    if not closed_b:
        return (head_a, tokens_a + count(head) + tokens, tail, True) if closed else (head_a, tokens_a, head, True)
    inner = count(head) + tokens + (count(tail) if closed else 0)
    return head_a, tokens_a + inner + tokens_b, tail_b, True


def total_of_blocks(count, maps) -> int:
    """Tokens of a whole text from the maps of its blocks, in order, in time linear in what they carry.

    The same as composing them one after the other; blocks without a chunk end
    are laid together once, when the chunk that runs through them ends.
    """
    open_, tokens = [], 0
    for head, inside, tail, closed in maps:
        open_.append(head)
        if closed:
            tokens += sum(map(count, CHUNK.findall("".join(open_)))) + inside
            open_ = [tail]
    return tokens + sum(map(count, CHUNK.findall("".join(open_))))


def total_of(count, m) -> int:
    """Tokens of a whole text (with its added space in front) from its map."""
    head, tokens, tail, closed = m
    return tokens + sum(map(count, [x for x in (head, tail) if x]))


class _Counter(dict):
    """Tokens of chunks met before; the transducer runs on the others."""

    def __init__(self, model: Model, bound: int):
        super().__init__()
        self.transducer, self.bound = Transducer(model), bound

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = self.transducer.count(chunk)
        return n

    def trim(self) -> None:
        if len(self) > self.bound:
            self.clear()


def _count_whole(counter: _Counter, texts) -> np.ndarray:
    """Tokens of each text of a slice."""
    words, offsets = ragged(pc.split_pattern(texts, " "))
    code, distinct = codes_of(words)
    distinct = distinct.to_pylist()
    if not any(w == "" or SPACE in w for w in distinct):
        return sums(np.array([counter[" " + w] for w in distinct], np.int64)[code], offsets)
    return np.array([sum(map(counter.__getitem__, CHUNK.findall(" " + t))) if t else 0 for t in texts.to_pylist()], np.int64)


def _block_counter(data: bytes, cache_chunks: int):
    def run(batches):
        counter = _Counter(Model(data), cache_chunks)
        for part, texts in text_slices(batches):
            counter.trim()
            single = part.column("_blocks").to_numpy(zero_copy_only=False) == 1
            head, tokens, tail, closed = [""] * len(texts), np.zeros(len(texts), np.int64), [""] * len(texts), np.zeros(len(texts), bool)
            if single.any():
                tokens[single] = _count_whole(counter, texts.filter(pa.array(single)))
            number = part.column("_block").to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(~single):
                text = texts[int(i)].as_py()
                head[i], tokens[i], tail[i], closed[i] = block_map(counter.__getitem__, (" " if number[i] == 0 else "") + text)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(head), pa.array(tokens), pa.array(tail), pa.array(closed)],
                names=[*part.schema.names[:-1], "_head", "_tokens", "_tail", "_closed"])
    return run


def _composer(data: bytes, cache_chunks: int):
    def run(batches):
        counter = _Counter(Model(data), cache_chunks)
        count = counter.__getitem__
        for batch in batches:
            counter.trim()
            totals = [total_of_blocks(count, [(m["_head"], m["_tokens"], m["_tail"], m["_closed"]) for m in maps])
                      for maps in batch.column("_maps").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(totals, pa.int64())],
                                             names=[*batch.schema.names[:-1], "_tokens"])
    return run


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block_chars: int = 1 << 16, cache_chunks: int = 150_000) -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_tokens``."""
    with open(model_path, "rb") as f:
        data = f.read()
    Transducer(Model(data))  # an unsupported model fails here
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.greatest(F.lit(1), F.ceil(F.char_length(text) / block_chars).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * block_chars + 1, F.lit(block_chars)))
    blocks = docs.select(
        F.col(id_col).alias("_id"), F.octet_length(text).cast("long").alias("_bytes"), F.xxhash64(text).alias("_tag"),
        n.alias("_blocks"), F.posexplode(F.when(n == 1, F.array(text)).otherwise(cut)).alias("_block", "text"))
    maps = stage(blocks.mapInArrow(
        _block_counter(data, cache_chunks),
        f"_id {kind}, _bytes long, _tag long, _blocks int, _block int, _head string, _tokens long, _tail string, _closed boolean"),
        "token-maps")
    key = ["_id", "_bytes", "_tag", "_blocks"]
    parts = F.array_sort(F.collect_set(F.struct("_block", "_head", "_tokens", "_tail", "_closed")))
    long_texts = (maps.where("_blocks > 1").groupBy(*key)  # rows that agree in id and text share their blocks
                  .agg(F.count_if(F.col("_block") == 0).alias("_rows"), parts.alias("_maps"))
                  .select("_id", "_bytes", "_rows", "_maps")
                  .mapInArrow(_composer(data, cache_chunks), f"_id {kind}, _bytes long, _rows long, _tokens long")
                  .select("_id", "_bytes", "_tokens", F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_n")).drop("_n"))
    return (maps.where("_blocks = 1").select("_id", "_bytes", "_tokens").unionAll(long_texts)
            .toDF(id_col, "n_bytes", "n_tokens"))

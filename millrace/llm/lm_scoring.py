"""Language-model scores of whole documents.

Word counts over all training documents give the base score and the words a
recurrent model predicts one by one; all other words share one symbol, whose
mass is divided by the same counts.  The recurrent model is trained in rounds,
each on its own share of the training documents.  In a round every part of the
documents, chosen by their hash, trains on from the parameters of the round
before; the mean of the parts begins the next round.  Rounds and parts follow from
the documents alone, not from how their table is cut.  Texts are split and looked up
once; training and scoring read their symbols.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from collections.abc import Iterator
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm import recurrent
from millrace.llm.common import give_back, map_batches, release_shuffles, sized, smaller_batches
from millrace.sources.storage import materialize

FOLDS, HELD = 5, 1
KNOWN = 1 << 18  # frequent words that every task holds; the others are joined
SEGMENT = 64  # tokens of a training segment
TRAIN_LANES = 1024  # segments side by side
ROUNDS = 4  # of training; each document takes part in one
PART_TOKENS = 1 << 18  # of a round with one part; parts grow with the square root of the tokens
SCORE_LANES = 1024  # texts side by side, when they are scored
TEXTS = 4096  # texts that are trained on, or scored, side by side
FAN = 16  # parts that are added up in one step
SLICES = 32  # of the parameter vector, when it is averaged
SIDE = 256  # at most so many classes of so many words are predicted one by one
CODE = "<u2"  # of a symbol, of which there are at most SIDE squared


def held_out(doc_id) -> bool:
    """Whether the document is kept from training; one without an id is trained on."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the batch in order, and where each text's words end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, ends = split.flatten(), np.asarray(split.offsets)[1:] - split.offsets[0].as_py()
    filled = pc.not_equal(words, "")
    kept = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    return words.filter(filled), kept[ends]


def _count_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    train = pa.array([not held_out(i) for i in batch.column("doc_id").to_pylist()])
    texts = batch.column("text").filter(train)
    words, _ = words_of(texts)
    counted = pc.value_counts(words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words)
    names = pa.concat_arrays([counted.field("values"), pa.array([""], words.type)])
    # the end of a text is the empty word
    counts = pa.concat_arrays([counted.field("counts"), pa.array([len(texts)], pa.int64())])
    return pa.RecordBatch.from_arrays([names.cast(pa.string()), counts], ["word", "n"])


class Lexicon:
    """Frequent words by falling count, and the totals of the training corpus."""

    def __init__(self, words: list[str], counts: list[int], ends: int, tokens: int, distinct: int):
        self.words, self.counts = pa.array(words, pa.string()), np.array(counts, np.int64)
        self.ends, self.tokens, self.distinct = ends, tokens, distinct
        # classes and members just enough for the frequent words and two symbols
        side = min(SIDE, max(2, math.ceil(math.sqrt(len(words) + 2))))
        self.symbols, self.vocabulary = side * side, side * side - 2
        own = self.counts[: self.vocabulary].sum()
        # words outside the model's vocabulary, of which an unseen one is one more
        self.rare_tokens = tokens - ends - int(own)
        self.rare_total = self.rare_tokens + 0.5 * (distinct - min(len(words), self.vocabulary))
        self.total = tokens + 0.5 * (distinct + 1)

    def symbol_counts(self) -> np.ndarray:
        shares = np.zeros(self.symbols)
        shares[[recurrent.END, recurrent.RARE]] = self.ends, self.rare_tokens
        top = self.counts[: self.vocabulary]
        shares[2 : 2 + len(top)] = top
        return shares

    def places(self, words: pa.Array) -> np.ndarray:
        """Place of each word among the frequent ones, -1 for others."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)


def symbols(places: np.ndarray, ends: np.ndarray, vocabulary: int) -> list[np.ndarray]:
    """Each text's symbols with its end."""
    coded = np.where((places >= 0) & (places < vocabulary), places + 2, recurrent.RARE)
    return [np.append(part, recurrent.END).astype(np.int32) for part in np.split(coded, ends[:-1])] if len(ends) else []


def lexicon(counts: DataFrame) -> Lexicon:
    """Totals, and the words frequent enough for at most KNOWN to be as frequent."""
    totals = counts.agg(
        F.sum("n").alias("tokens"),
        F.sum((F.col("n") > 0).cast("long")).alias("distinct"),
        F.sum(F.when(F.col("word") == "", F.col("n"))).alias("ends"),
    ).first()
    real = counts.where("word != '' and n > 0")
    # a row per eighth of an octave of counts
    level = F.floor(F.log2("n") * 8)
    ladder = sorted(((r[0], r[1]) for r in real.groupBy(level).count().collect()), reverse=True)
    held, lowest = 0, None
    for step, n in ladder:
        if held + n > KNOWN:
            break
        held, lowest = held + n, step
    top = real.where(level >= lowest).toArrow() if lowest is not None else real.limit(0).toArrow()
    order = np.lexsort((np.array(top.column("word").to_pylist(), object), -top.column("n").to_numpy()))
    taken = top.take(pa.array(order))
    return Lexicon(
        taken.column("word").to_pylist(), taken.column("n").to_pylist(), totals.ends or 0, totals.tokens or 0, totals.distinct or 0
    )


def _weighted(trainer: recurrent.Trainer, start: dict[str, np.ndarray]) -> np.ndarray:
    """How far parameters moved times their weight, then the weights of the rows of the sparse ones.

    A row weighs as many windows as had to do with it, so that parts which never
    met a word don't dilute what others learned of it; the rest weighs its tokens.
    """
    made = np.empty(sum(v.size for v in start.values()) + sum(len(start[n]) for n in recurrent.SPARSE), np.float32)
    at = 0
    for n in recurrent.NAMES:
        values = made[at : at + start[n].size].reshape(start[n].shape)
        weight = np.float32(trainer.tokens)
        if n in recurrent.SPARSE:
            weight = trainer.touched[n].astype(np.float32).reshape(-1, *[1] * (values.ndim - 1))
        np.subtract(trainer.params[n], start[n], out=values)
        values *= weight
        at += values.size
    made[at:] = np.concatenate([trainer.touched[n] for n in recurrent.SPARSE])
    return made


def _mean(start: np.ndarray, mass: np.ndarray, tokens: int, symbols: int) -> np.ndarray:
    """The parameters that all parts come to, from the sum of their `_weighted`."""
    moved, at = recurrent.unflat(mass[: len(start)].copy(), symbols), len(start)
    for n, values in moved.items():
        if n in recurrent.SPARSE:
            weight = np.maximum(mass[at : at + len(values)], 1)
            values /= weight.reshape(-1, *[1] * (values.ndim - 1))
            at += len(values)
        else:
            values /= np.float32(tokens)
    return start + recurrent.flat(moved)


def _code_batch(words: Lexicon):
    """Each row's symbols, and all that its scores need besides the model: later steps read no text."""
    logs = np.log10(words.counts + 0.5)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, ends = words_of(batch.column("text"))
        places = words.places(found)
        rare, outside = places < 0, (places < 0) | (places >= words.vocabulary)
        known = np.where(rare, 0.0, logs[places] if len(logs) else 0.0)
        upto = lambda values: np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(values)])[ends]]))
        n, n_rare, n_outside = np.diff(np.concatenate([[0], ends])), upto(rare), upto(outside)
        end_log = np.log10(words.ends + 0.5)
        base = upto(known) + end_log - (n + 1) * np.log10(words.total)
        rest = upto(np.where(outside & ~rare, known, 0.0)) - n_outside * np.log10(max(words.rare_total, 0.5))
        spelled = found.filter(pa.array(rare))
        spelled = spelled.combine_chunks() if isinstance(spelled, pa.ChunkedArray) else spelled
        offsets = np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32)
        coded = [part.astype(CODE).tobytes() for part in symbols(places, ends, words.vocabulary)]
        arrays = {
            "doc_id": batch.column("doc_id"),
            "held_out": pa.array([held_out(i) for i in batch.column("doc_id").to_pylist()], pa.bool_()),
            "n_tokens": pa.array(n + 1, pa.int64()),
            "n_known": pa.array(n - n_rare + (words.ends > 0), pa.int64()),
            "base_score": pa.array(base),
            "score": pa.array(rest),
            "rare": pa.ListArray.from_arrays(pa.array(offsets), spelled.cast(pa.string())),
            "symbols": pa.array(coded, pa.binary()),
        }
        if "key" in batch.schema.names:
            arrays["key"] = batch.column("key")
        return pa.RecordBatch.from_pydict(arrays)

    return work


def _decoded(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Each row's symbols, without a copy."""
    return [np.frombuffer(text.as_buffer(), CODE) for text in batch.column("symbols")]


def _train_task(words: Lexicon, start: np.ndarray, coded: bool = False):
    """A part's training on rows of texts, or on coded ones, for which tasks need no words."""
    code, count = (lambda batch: batch) if coded else _code_batch(words), words.symbols

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = recurrent.Trainer(recurrent.unflat(start, count))
        for batch in map(code, sized(batches, TEXTS)):
            texts = _decoded(batch.filter(pc.invert(batch.column("held_out"))))
            trainer.train([text[at : at + SEGMENT] for text in texts for at in range(0, len(text), SEGMENT)], TRAIN_LANES)
        if trainer.tokens:
            trainer.release()
            # what no window has changed is zero, and small when shuffled
            parts = np.array_split(_weighted(trainer, recurrent.unflat(start, count)), SLICES)
            task = TaskContext.get().partitionId()
            arrays = [pa.array([task] * SLICES, pa.int32()), pa.array(range(SLICES), pa.int32())]
            arrays += [pa.array([trainer.tokens] * SLICES, pa.int64()), pa.array(parts, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["task", "slice", "tokens", "mass"])
        give_back()

    return run


def _add_slices(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("task")
    masses = rows.column("mass").combine_chunks()
    total = masses.flatten().to_numpy().reshape(len(masses), -1).sum(axis=0, dtype=np.float64)
    arrays = [
        pa.array([rows.column("task")[0].as_py()], pa.int32()),
        pa.array([rows.column("slice")[0].as_py()], pa.int32()),
        pa.array([pc.sum(rows.column("tokens")).as_py()], pa.int64()),
        pa.array([total.astype(np.float32)], pa.list_(pa.float32())),
    ]
    return pa.table(arrays, ["task", "slice", "tokens", "mass"])


def deal(coded: DataFrame, turn: int, parts: int) -> DataFrame:
    """The round's training rows, a part to a partition and in a fixed order.

    The part is the partition's number itself, so there are as many partitions with
    rows as parts, each of which gives one vector, whatever the session's settings.
    """
    mine = coded.where(~F.col("held_out") & (F.pmod("key", F.lit(ROUNDS)) == turn))
    part = F.pmod(F.hash("key"), F.lit(parts))
    rows = mine.select("key", "doc_id", "held_out", "symbols").repartitionById(parts, part)
    return rows.sortWithinPartitions("key", "doc_id", "symbols").select("held_out", "symbols")


def train(coded: DataFrame, words: Lexicon) -> np.ndarray:
    """Parameters after all rounds; the start if there are no training documents."""
    vector = recurrent.flat(recurrent.initial(words.symbol_counts()))
    schema = "task int, slice int, tokens long, mass array<float>"
    smaller_batches(coded.sparkSession)
    parts = max(1, math.ceil(math.sqrt(words.tokens / ROUNDS / PART_TOKENS)))
    for turn in range(ROUNDS):
        trained = deal(coded, turn, parts).mapInArrow(_train_task(words, vector, coded=True), schema)
        if parts > FAN:
            # two levels: as many first groups as the root of the number of parts, with at most twice as many members
            trained = trained.groupBy(F.floor(F.sqrt("task")).alias("fan"), "slice").applyInArrow(_add_slices, schema)
        rows = trained.groupBy("slice").applyInArrow(_add_slices, schema).toArrow().sort_by("slice")
        release_shuffles(coded.sparkSession)
        if rows.num_rows:
            mass = rows.column("mass").combine_chunks().flatten().to_numpy()
            vector = _mean(vector, mass, rows.column("tokens")[0].as_py(), words.symbols)
    return vector


def _score_batch(words: Lexicon, vector: np.ndarray):
    count = words.symbols  # tasks need no words

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        params = recurrent.unflat(vector, count)
        model = recurrent.score_texts(params, _decoded(batch), SCORE_LANES) / np.log(10)
        columns = {n: batch.column(n) for n in batch.schema.names if n != "symbols"}
        return pa.RecordBatch.from_pydict(columns | {"score": pc.add(columns["score"], pa.array(model))})

    return work


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` per row of `docs`.

    Scores are log10 probabilities of whole texts with their ends; a null or
    empty text is an end alone.  Rows are scored one by one, so ids may be null
    (then trained on) or repeated (then counted twice).  Without training
    documents every count is zero and the model predicts evenly.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = map_batches(chosen, _count_batch, "word string, n long", TEXTS).groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where("n > 0"), "counts")
    words = lexicon(counts)
    # rows without an id are dealt out by place
    keyed = chosen.withColumn("key", F.xxhash64(F.coalesce("doc_id", F.monotonically_increasing_id()), "text"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    coded = map_batches(keyed, _code_batch(words), f"{schema}, rare array<string>, symbols binary, key long")
    coded = materialize(coded.withColumn("row", F.monotonically_increasing_id()), "coded")
    vector = train(coded, words)
    scored = map_batches(coded.drop("rare", "key"), _score_batch(words, vector), f"{schema}, row long", TEXTS)
    scored = materialize(scored, "scored")
    rare = coded.where(F.size("rare") > 0).select("row", F.explode("rare").alias("word"))
    found = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.count("n").alias("seen")
    )
    added = F.coalesce("logs", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + added).alias("base_score"),
        (F.col("score") + added).alias("score"),
    )

"""Quality rules from distribution divergence.

Every document becomes two small histograms, one of character classes and one
of common words.  The references are sums of such histograms over all documents
of a language that pass the base rules, so they follow the corpus.  A document
stays when, for its nearest language, the Jensen-Shannon distances to the
references are small enough; a histogram with too few entries to say anything is not held
against a document.

Bound: the languages are those of `COMMON_WORDS`.  A document in another language
or script is held against the nearest of them, and mostly fails.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_batches, texts_of
from millrace.sources.storage import materialize

# Frequent function words of each language, in ASCII lower case.
COMMON_WORDS = {
    "en": "the of and to in a is it that for on with as be by this are was or from at an not which have",
    "fr": "le de un une et la les des du en que pour dans ce il qui ne sur se pas plus par est au avec",
    "de": "der die das und in zu den mit von für auf ist im dem nicht ein eine als auch es an sich aus bei",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero",
}
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MIN_CHARS = 150  # characters a class histogram needs to count
MIN_COMMON = 40  # words a word histogram needs to count
MAX_CLASS_DISTANCE = 0.24
MAX_DISTANCE_SUM = 0.46

VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
_INDEX = {w.encode(): i for i, w in enumerate(VOCABULARY)}
_REST = len(VOCABULARY)
_OWN = {lang: np.array([VOCABULARY.index(w) for w in words.split()]) for lang, words in COMMON_WORDS.items()}

SPACE, LOWER, UPPER, DIGIT, STOP, OTHER, SYMBOL, WIDE, CONTINUED = range(9)
_CLASS = np.full(256, OTHER, np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = LOWER, UPPER, DIGIT
_CLASS[[ord(c) for c in ".,;:'\"!?()-"]] = STOP
_CLASS[[ord(c) for c in SYMBOLS]] = SYMBOL
_CLASS[0x80:0xC0], _CLASS[0xC0:] = CONTINUED, WIDE
_CLASSES = [LOWER, UPPER, DIGIT, STOP, OTHER, SYMBOL, WIDE]
_EDGES = bytes.maketrans(b".,;:!?\"()", b" " * 9)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD], np.uint64)

FEATURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "classes array<long>, common array<long>"
)
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a `window`-word run that occurs twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = np.zeros(n, np.uint64)
    for k in range(window):
        runs += codes[k : k + n] * _MIX[k % len(_MIX)] ^ (codes[k : k + n] >> np.uint64(29 + k))
    order = np.argsort(runs, kind="stable")
    same = runs[order[1:]] == runs[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + n] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n += line in seen
            seen.add(line)
    return n


def measure(text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The five counts, the class histogram and the common-word histogram of a text."""
    raw = text.encode()
    words = raw.split()
    classes = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9)
    plain = raw.lower().translate(_EDGES).split()
    found = np.fromiter((_INDEX.get(w, _REST) for w in plain), np.int64, len(plain))
    common = np.bincount(found, minlength=_REST + 1)
    counts = [
        len(words),
        int(len(raw) - classes[CONTINUED] - classes[SPACE]),
        int(classes[SYMBOL]),
        duplicate_lines(raw),
        repeated_words(words),
    ]
    return counts, classes[_CLASSES], common


def _feature_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    measured = [measure(t) for t in texts_of(batch.column("text"))]
    counts = np.array([m[0] for m in measured], np.int64)
    arrays = [batch.column("doc_id"), *[pa.array(counts[:, i]) for i in range(len(_COUNTS))]]
    arrays += [pa.array([m[k].tolist() for m in measured], pa.list_(pa.int64())) for k in (1, 2)]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", *_COUNTS, "classes", "common"])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and histograms per row; a missing text has none of anything."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(chosen, _feature_batch, FEATURES)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(float)


def _language(common: np.ndarray) -> np.ndarray:
    """Language with the most common words in each row, as its position in the list."""
    return np.argmax(np.stack([common[:, own].sum(axis=1) for own in _OWN.values()], axis=1), axis=1)


def base_failed():
    """Too few words, or too many of them in repeated runs."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _reference_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    both = np.concatenate([_matrix(batch.column("classes")), _matrix(batch.column("common"))], axis=1)
    lang = _language(both[:, len(_CLASSES) :])
    # each document counts as one, whatever its length
    both[:, : len(_CLASSES)] /= np.maximum(both[:, : len(_CLASSES)].sum(axis=1, keepdims=True), 1)
    both[:, len(_CLASSES) :] /= np.maximum(both[:, len(_CLASSES) :].sum(axis=1, keepdims=True), 1)
    rows = [(k, i, float(v)) for k in np.unique(lang) for i, v in enumerate(both[lang == k].sum(axis=0))]
    arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.float64()))]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "place", "mass"])


def references(table: DataFrame) -> np.ndarray:
    """One histogram pair per language, over all documents of `table` that pass the base rules.

    Bounded: languages times classes and vocabulary, whatever the corpus.
    """
    usable = table.where(~base_failed() & (F.col("n_words") >= MIN_COMMON)).select("classes", "common")
    sums = map_batches(usable, _reference_batch, "lang int, place int, mass double")
    total = np.zeros((len(_OWN), len(_CLASSES) + _REST + 1))
    for row in sums.groupBy("lang", "place").agg(F.sum("mass").alias("mass")).collect():
        total[row.lang, row.place] = row.mass
    return total


def distance(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row to one reference; 1 where either is empty."""
    p = rows / np.maximum(rows.sum(axis=1, keepdims=True), 1e-300)
    q = np.broadcast_to(reference / max(reference.sum(), 1e-300), p.shape)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    result = np.sqrt(np.clip(terms.sum(axis=1) / 2, 0, 1))
    empty = (rows.sum(axis=1) == 0) | (reference.sum() == 0)
    return np.where(empty, 1.0, result)


def distances(classes: np.ndarray, common: np.ndarray, reference: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and word distance of each row to its nearest language; 0 below the minimum lengths."""
    by_class, by_word = [], []
    for k, own in enumerate(_OWN.values()):
        words = reference[k, len(_CLASSES) :]
        if not words.sum():
            continue
        rest = lambda h, own=own: np.append(h[..., own], (h.sum(axis=-1) - h[..., own].sum(axis=-1))[..., None], axis=-1)
        by_class.append(distance(classes, reference[k, : len(_CLASSES)]))
        by_word.append(distance(rest(common), rest(words)))
    zero = np.zeros(len(classes))
    if not by_class:
        return zero, zero
    best = np.argmin(np.add(by_class, by_word), axis=0)
    pick = lambda found: np.stack(found)[best, np.arange(len(best))]
    near_class = np.where(classes.sum(axis=1) >= MIN_CHARS, pick(by_class), 0)
    near_word = np.where(common.sum(axis=1) >= MIN_COMMON, pick(by_word), 0)
    return near_class, near_word


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base counts, both distances, `base_failed` and `kept`, one row per row of `docs`.

    Null and empty texts have no words and fail.  Ids may be null or repeated:
    rows are judged one by one.  Without any usable document there is no
    reference, and the base rules alone decide.  Other columns are not read.
    """
    table = materialize(features(docs, id_col, text_col).withColumn("base_failed", base_failed()), "features")
    reference = references(table)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        near_class, near_word = distances(_matrix(batch.column("classes")), _matrix(batch.column("common")), reference)
        failed = batch.column("base_failed").to_numpy(zero_copy_only=False)
        kept = ~failed & _close(near_class, near_word)
        arrays = [*batch.columns[:-3], batch.column("base_failed"), pa.array(near_class), pa.array(near_word), pa.array(kept)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", *_COUNTS, "base_failed", "class_distance", "word_distance", "kept"])

    return map_batches(
        table,
        work,
        "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, "
        "class_distance double, word_distance double, kept boolean",
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of `docs` that `judge` keeps, all columns unchanged.

    The verdict needs the references only, so the documents are read twice and
    never shuffled.
    """
    reference = references(materialize(features(docs, id_col, text_col), "features"))
    verdict = _verdicts(reference)
    place = docs.columns.index(text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(verdict(texts_of(batch.column(place)))))

    return map_batches(docs, work, docs.schema)


def _verdicts(reference: np.ndarray):
    def judge_texts(texts: list[str]) -> np.ndarray:
        measured = [measure(t) for t in texts]
        counts = np.array([m[0] for m in measured])
        near_class, near_word = distances(*[np.array([m[k] for m in measured], float) for k in (1, 2)], reference)
        failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
        return ~failed & _close(near_class, near_word)

    return judge_texts


def _close(near_class: np.ndarray, near_word: np.ndarray) -> np.ndarray:
    return (near_class <= MAX_CLASS_DISTANCE) & (near_class + near_word <= MAX_DISTANCE_SUM)

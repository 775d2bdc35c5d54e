"""Collocations by prefix-free parsing.

Every text is cut into overlapping chunks whose borders its own words choose: a
chunk begins at a window of `OVERLAP` words with a chosen hash and ends with the next
such window, so equal passages give equal chunks wherever they stand.  The distinct
chunks with the number of their occurrences (the parse) stand for the corpus: phrases
are counted inside each chunk once and weighted.  A phrase that begins in the closing
window of a chunk is left to the next chunk, which begins with that window, so
overlaps count once.

Only phrases that may be frequent are ever spelled out.  Hashes of words, then of pairs
and of triples, are counted first, and those that reach the support set bits of a map
of fixed size.  The bits only leave out what cannot reach the support: equal hashes add up, a full map
leaves out nothing, and the counts that decide are those of the spelled phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.llm.common import give_back, release_shuffles, smaller_batches, weighed
from millrace.sources.storage import materialize

SUPPORT = 30
LONGEST = 4  # words of a phrase
TOP = 2000
ABSORBED = 80  # per cent of a phrase's occurrences inside a longer one
OVERLAP = LONGEST - 1  # words that neighbouring chunks share
SPACING = 32  # mean words between chosen windows
FARTHEST = 4096  # words after which a border is set in any case
MAP_BITS = 1 << 27  # of the map of frequent hashes: 16 MB on the driver and in each worker
BITS_A_ROW = 32768  # of Spark's bitmap aggregates

# Texts are parsed in groups of so many bytes; longer ones are cut behind a separator.
GROUP_BYTES = 4 << 20
ROWS = 1000

BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
_IN_WORD, _SPACE, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = _SPACE
_KIND[list(BREAKS)] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# Hashes of words are polynomials of their bytes modulo 2^64, taken from running sums.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * GROUP_BYTES)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)])) for base in (_BASE, _INVERSE)]
    return _POWERS


@dataclass
class Words:
    """The words of some texts in their order."""

    bytes_: np.ndarray  # the words, each followed by a space, or by a line end before a new piece
    starts: np.ndarray  # of each word in bytes_
    ends: np.ndarray
    hashes: np.ndarray  # of each word
    piece: np.ndarray  # number of each word's piece; pieces never span texts
    text: np.ndarray  # number of each word's text

    @property
    def count(self) -> int:
        return len(self.starts)

    def numbered(self) -> tuple[np.ndarray, int]:
        """Each word's number among the distinct words, by their letters, and how many these are."""
        inside = np.ones(len(self.bytes_), bool)
        inside[self.ends] = False
        bounds = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(self.bytes_[inside])]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.count, buffers).dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)


def split_words(texts: list[bytes]) -> Words:
    """Words of UTF-8 texts, A-Z lower-cased, with their pieces."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind, lower = _KIND[data], _LOWER[data]
    inside = kind == _IN_WORD
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    begins, ended = edges[::2], edges[1::2]
    lengths = ended - begins
    breaks = np.flatnonzero(kind == _BREAK)
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)

    # each word keeps one byte behind it, which becomes its separator
    inside[ended] = True
    spelled = lower[inside]
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    piece = np.searchsorted(breaks, begins)
    opens = np.concatenate([piece[1:] != piece[:-1], [True]]) if len(piece) else np.zeros(0, bool)
    spelled[ends] = np.where(opens, 10, 32)
    up, down = _powers(len(spelled) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((spelled + np.uint64(1)) * up[: len(spelled)])])
    return Words(
        bytes_=spelled,
        starts=starts,
        ends=ends,
        hashes=_mixed((sums[ends] - sums[starts]) * down[starts]),
        piece=piece,
        text=np.searchsorted(text_ends, begins, "right"),
    )


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads neighbouring ones."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of pairs, in order."""
    return _mixed(_mixed(first) * np.uint64(3) + second)


def _sections(text: bytes) -> Iterator[bytes]:
    """The text, or parts of about GROUP_BYTES that end behind a separator of pieces."""
    at = 0
    while len(text) - at > GROUP_BYTES:
        ends = [text.find(b, at + GROUP_BYTES) for b in (b"\n", b".", b",")]
        end = min([e for e in ends if e >= 0], default=-1)
        if end < 0:
            break
        yield text[at : end + 1]
        at = end + 1
    yield text[at:]


def _chunks_of(texts: list[bytes], spacing: int) -> Iterator[tuple[int, bool, bytes]]:
    """(number of the text, whether the chunk is its last, chunk) of each chunk."""
    words = split_words(texts)
    n = words.count
    if not n:
        return
    new_text = np.concatenate([[True], words.text[1:] != words.text[:-1]])
    begin_of = np.flatnonzero(new_text)
    place = np.arange(n) - begin_of[np.cumsum(new_text) - 1]
    hashes = words.hashes
    chosen = np.zeros(n, bool)
    if n >= OVERLAP:
        window = hashes[: n - OVERLAP + 1]
        for k in range(1, OVERLAP):
            window = _joined(window, hashes[k : n - OVERLAP + 1 + k])
        whole = words.text[: len(window)] == words.text[OVERLAP - 1 :]
        far = place[: len(window)] % FARTHEST == 0
        chosen[: len(window)] = whole & ((window % np.uint64(spacing) == 0) | far)
    firsts = np.flatnonzero(chosen | new_text)
    last = np.concatenate([new_text[firsts[1:]], [True]])
    following = np.concatenate([firsts[1:], [n]])
    finals = np.where(last, following - 1, following + OVERLAP - 1)
    spelled = words.bytes_.tobytes()
    starts, ends, numbers = words.starts[firsts].tolist(), words.ends[finals].tolist(), words.text[firsts].tolist()
    for number, closing, start, end in zip(numbers, last.tolist(), starts, ends):
        yield number, closing, spelled[start:end]


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", spacing: int = SPACING) -> DataFrame:
    """The distinct chunks of all texts: lang, last, chunk, weight."""
    smaller_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, "text", ROWS, GROUP_BYTES):
            langs, parts, owner = batch.column("lang").to_pylist(), [], []
            for number, text in enumerate(batch.column("text").to_pylist()):
                for part in _sections((text or "").encode()):
                    parts.append(part)
                    owner.append(number)
            at = 0
            while at < len(parts):
                end, size = at + 1, len(parts[at])
                while end < len(parts) and size + len(parts[end]) <= GROUP_BYTES:
                    size += len(parts[end])
                    end += 1
                found = list(_chunks_of(parts[at:end], spacing))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([langs[owner[at + number]] for number, _, _ in found], pa.string()),
                        pa.array([closing for _, closing, _ in found], pa.bool_()),
                        pa.array([chunk for _, _, chunk in found], pa.binary()),
                    ],
                    ["lang", "last", "chunk"],
                )
                at = end
        give_back()

    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    chunks = texts.mapInArrow(run, "lang string, last boolean, chunk binary")
    return chunks.groupBy("lang", "last", "chunk").agg(F.count("*").alias("weight"))


@dataclass
class Places:
    """Where phrases may begin in a batch of chunks."""

    words: Words
    langs: list[str]  # distinct
    lang: np.ndarray  # number of each word's language
    weight: np.ndarray  # occurrences of each word's chunk
    owned: np.ndarray  # whether a phrase that begins here counts in this chunk

    def word_hashes(self) -> np.ndarray:
        """Hashes of the words, each with its language."""
        names = np.array([xxhash.xxh64_intdigest(name) for name in self.langs], np.uint64)
        return _joined(names[self.lang], self.words.hashes) if self.words.count else np.zeros(0, np.uint64)

    def levels(self, maps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For phrases of 1, 2, ... words: their hashes by first word, and where one may be frequent.

        A phrase may be if it lies in one piece and both phrases that are a word
        shorter are in their map; one with a map of its own must be in that too.
        """
        first = self.word_hashes()
        hashes, may = first, np.ones(self.words.count, bool)
        for n in range(1, LONGEST + 1):
            if n <= len(maps):
                at = np.flatnonzero(may)
                may[at] = _in_map(maps[n - 1], hashes[at])
            yield hashes, may
            if n > len(maps):
                return
            left = max(self.words.count - n, 0)
            may = may[:left] & may[1 : left + 1] & (self.words.piece[:left] == self.words.piece[n:])
            hashes = _joined(hashes[:left], first[n:])


def _places(batch: pa.RecordBatch) -> Places:
    words = split_words(batch.column("chunk").to_pylist())
    langs = batch.column("lang").dictionary_encode()
    last = batch.column("last").to_numpy(zero_copy_only=False)
    sizes = np.bincount(words.text, minlength=batch.num_rows)
    left = np.cumsum(sizes)[words.text] - np.arange(words.count)  # words from here to the chunk's end
    return Places(
        words=words,
        langs=langs.dictionary.to_pylist(),
        lang=langs.indices.to_numpy()[words.text],
        weight=batch.column("weight").to_numpy()[words.text],
        owned=last[words.text] | (left > OVERLAP),
    )


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of one of each, and the sums of their weights."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[firsts], order[firsts], np.add.reduceat(weights[order], firsts)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    """32 bits of each hash, which are what is counted."""
    return (hashes >> np.uint64(32)).astype(np.int64)


def _in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bucket(hashes) & (MAP_BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _over(parsed: DataFrame, work, schema: str) -> DataFrame:
    """`work` from the places of each group of chunks to columns."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, "chunk", GROUP_BYTES // 64, GROUP_BYTES):
            for columns in work(_places(batch)):
                yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    return parsed.mapInArrow(run, schema)


def _map_of_frequent(parsed: DataFrame, maps: list, support: int):
    """Broadcast bits of the hashes of phrases that reach the support, one word longer than those of the last map."""

    def count(found: Places):
        *_, (hashes, may) = found.levels([m.value for m in maps])
        at = np.flatnonzero(may & found.owned[: len(may)])
        buckets, _, sums = _summed(_bucket(hashes[at]), found.weight[at])
        yield [pa.array(buckets.astype(np.uint32).view(np.int32)), pa.array(sums.astype(np.int64))]

    counted = _over(parsed, count, "bucket int, count long")
    frequent = counted.groupBy("bucket").agg(F.sum("count").alias("count")).where(F.col("count") >= support)
    place = F.col("bucket").bitwiseAND(MAP_BITS - 1).cast("long") + 1
    rows = (
        frequent.groupBy(F.bitmap_bucket_number(place).alias("row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()  # MAP_BITS / BITS_A_ROW rows at most, 16 MB
    )
    bits = np.zeros(MAP_BITS // 8, np.uint8)
    width = BITS_A_ROW // 8
    for row in rows:
        bits[(row["row"] - 1) * width : row["row"] * width] = np.frombuffer(row["bits"], np.uint8)
    return parsed.sparkSession.sparkContext.broadcast(bits)


def frequent_phrases(parsed: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Phrases of 1 to LONGEST words that occur `support` times in a language: lang, phrase, size, count.

    Of size 0 is one empty phrase for each language, with all its words as the count.
    """
    maps: list = []
    for _ in range(1, LONGEST):
        maps.append(_map_of_frequent(parsed, maps, support))
        release_shuffles(parsed.sparkSession)

    def phrases(found: Places):
        words = found.words
        spelled = words.bytes_.tobytes()
        ids, distinct = words.numbered()

        def columns(firsts: np.ndarray, n: int, sums: np.ndarray, texts: list[str]) -> list[pa.Array]:
            langs = [found.langs[k] for k in found.lang[firsts].tolist()]
            return [pa.array(langs, pa.string()), pa.array(texts, pa.string()), pa.array(np.full(len(firsts), n, np.int32)), pa.array(sums.astype(np.int64))]

        own = np.flatnonzero(found.owned)
        keys, sample, sums = _summed(found.lang[own].astype(np.int64), found.weight[own])
        yield columns(own[sample], 0, sums, [""] * len(keys))
        # exact numbers of the phrases that begin at each place, from those of the shorter ones and the next word
        number = found.lang.astype(np.int64)
        for n, (_, may) in enumerate(found.levels([m.value for m in maps]), 1):
            at = np.flatnonzero(may)  # not only what counts here: a longer phrase may
            keys = number[at] * distinct + ids[at + n - 1]
            number[at] = np.unique(keys, return_inverse=True)[1]
            at = at[found.owned[at]]
            _, sample, sums = _summed(number[at], found.weight[at])
            firsts = at[sample]
            starts, ends = words.starts[firsts].tolist(), words.ends[firsts + n - 1].tolist()
            yield columns(firsts, n, sums, [spelled[s:e].decode() for s, e in zip(starts, ends)])

    counted = _over(parsed, phrases, "lang string, phrase string, size int, count long")
    totals = counted.groupBy("lang", "phrase", "size").agg(F.sum("count").alias("count"))
    return totals.where((F.col("count") >= support) | (F.col("size") == 0))


def _first_ranks(df: DataFrame, order: list, top: int) -> DataFrame:
    """The first `top` rows of each language; slices of a language are cut down before they meet."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.pmod(F.xxhash64("phrase"), F.lit(slices))
    local = F.row_number().over(W.partitionBy("lang", "__piece").orderBy(*order))
    few = df.withColumn("__piece", piece).withColumn("rank", local).where(F.col("rank") <= top).drop("__piece")
    return few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, top: int = TOP, spacing: int = SPACING
) -> DataFrame:
    """The phrases of 2 to 4 words that hold together best, by language.

    Returns lang, rank, phrase, a (occurrences), l, r (those of the parts of the cut
    with the lowest score), n (words of the language) and score = floor(2000000 a / (l + r)).
    A phrase is left out if a longer one of `support` occurrences that holds it has at
    least 80 % of its occurrences.  Ties: more occurrences, then the phrase in byte order.

    Null texts are empty and give nothing, null languages are `und`; repeated rows
    count as often as they stand; very long texts are parsed in parts, cut where no phrase can
    span; an empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    parsed = materialize(parse(docs, text_col, lang_col, spacing), "parse")
    release_shuffles(spark)
    counted = materialize(frequent_phrases(parsed, support), "phrases")
    release_shuffles(spark)
    sizes = counted.where("size = 0").select("lang", F.col("count").alias("n"))
    frequent = counted.where("size >= 1")
    candidates = frequent.where("size >= 2")
    words = F.split("phrase", " ")
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        "phrase",
        "size",
        "k",
        F.col("count").alias("a"),
        F.array_join(F.slice(words, F.lit(1), k), " ").alias("head"),
        F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("tail"),
    )
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("count").alias("r"))
    wide = "decimal(38,0)"
    score = F.expr(f"cast(a as decimal(20,0)) * 2000000BD div (cast(l as {wide}) + r)")
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "size")
        .agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )

    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
        " s -> array_join(slice(split(phrase, ' '), s, m), ' '))))"
    )
    inside = candidates.where("size >= 3").select("lang", F.explode(inner).alias("phrase"), F.col("count").alias("longer"))
    held = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    absorbed = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * ABSORBED
    kept = scored.join(held, ["lang", "phrase"], "left").where(~F.coalesce(absorbed, F.lit(False)))

    ranked = _first_ranks(kept, [F.desc("score"), F.desc("a"), "phrase"], top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Phrases whose words stand together more often than apart, per language.

Shards of words are counted as weighted automata (``automata``) over words of their own, built from the shard's sorted three-word
paths. The words' counts make one vocabulary per language; a word's number is its rank in byte order, so
a shard's paths stay sorted when they take the common numbers. The vocabulary's prefix sums cut the paths into prefix ranges
of about equal size; a word too frequent for one range has several. The automata of a range are united, weights added: their
paths and beginnings are the counts of three- and two-word phrases. With many ranges the union goes in levels, each of which splits by
prefix and unites pools of shards, so that messages grow with the shards and not with their square. The counts of a
phrase's parts are looked up by composition with the count automata, which is a join on the part's labels.

Words and pieces are bytes of the whole text; only A to Z are lower-cased. A null or empty text has no words; one of any length
counts whole, a block of words at a time. A null language is ``und``. Repeated rows count as often as they come, ties rank by phrase
in byte order, an empty table gives no phrases. Only ``lang`` and ``text`` are read, so other columns cannot clash.
Counts must stay below 10**15. No vocabulary or table of phrases passes the driver, of whatever size (``_merged``).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import automata
from tidemark.llm.automata import Paths
from tidemark.llm.prefix import prefixes
from tidemark.llm.spread import written
from tidemark.llm.words import buffers, byte_table, slices, words

# Fixed values
LEAST = 10
FIRST = 2000
SCALE = 1_000_000
# A phrase goes if a longer one that holds it has this share of its occurrences.
HELD_PERCENT = 50
NO_LANGUAGE = "und"

BREAKS = byte_table(*b".,;:!?", *range(0x0A, 0x0E))
MEMBERS = ~(BREAKS | byte_table(0x20, 0x09))
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A") : ord("Z") + 1] += 32

# Words of a shard, words of a prefix range, and ranges that one level of the union splits into.
SHARD_WORDS = 1 << 20
RANGE_WORDS = 1 << 20
FAN = 256

# Bits of a label within a shard; a shard has fewer than 1.5 SHARD_WORDS words.
_BITS = 21

SHARDS = "shard long, lang string, words array<binary>, counts array<long>, automaton binary"
MESSAGES = "lang string, prefix long, shard long, automaton binary"
COUNTS = "lang string, a long, b long, c long, n long"


# ---------------------------------------------------------------- shards


class Shard:
    """The words of one language that a task has read since the last automaton."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.tokens, self.pieces, self.starts, self.size, self.piece = [], [], [], 0, 0

    def add(self, tokens: pa.Array, pieces: np.ndarray, begin: int, end: int) -> None:
        """Phrases that start at words ``begin`` to ``end``. Two words more are seen, and counted elsewhere."""
        seen = min(end + 2, len(tokens))
        self.tokens.append(tokens.slice(begin, seen - begin))
        self.pieces.append(pieces[begin:seen] - pieces[begin] + self.piece)
        self.starts.append(np.arange(begin, seen) < end)
        self.piece = int(self.pieces[-1][-1]) + 1
        self.size += end - begin

    def counted(self) -> tuple[pa.Array, np.ndarray, bytes]:
        """The words in byte order, their counts and the automaton of two- and three-word paths."""
        encoded = pa.concat_arrays(self.tokens).dictionary_encode()
        order = pc.sort_indices(encoded.dictionary).to_numpy()
        label = np.empty(len(order), np.int64)
        label[order] = np.arange(len(order))
        ids = label[encoded.indices.to_numpy()]
        pieces, starts = np.concatenate(self.pieces), np.concatenate(self.starts)
        counts = np.bincount(ids[starts], minlength=len(order))

        second = np.zeros(len(ids), np.int64)
        second[:-1] = np.where(pieces[1:] == pieces[:-1], ids[1:] + 1, 0)
        third = np.zeros(len(ids), np.int64)
        third[:-2] = np.where(pieces[2:] == pieces[:-2], ids[2:] + 1, 0)
        chosen = starts & (second > 0)
        code = ((ids[chosen] + 1) << (2 * _BITS)) | (second[chosen] << _BITS) | third[chosen]
        code.sort()
        heads = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
        weight = np.diff(np.r_[heads, len(code)])
        code, mask = code[heads], (1 << _BITS) - 1
        none = np.zeros(len(code), np.int64)
        paths = Paths(code >> (2 * _BITS), (code >> _BITS) & mask, code & mask, weight, none, none)
        return encoded.dictionary.take(pa.array(order)), counts, automata.dump(paths)


def tokens(column: pa.Array):
    """The words of each slice of a text column, and the piece each stands in."""
    data, offsets = buffers(column)
    for lo, hi in slices(offsets):
        part = _LOWERED[data[offsets[lo] : offsets[hi]]]
        found = words(part, offsets[lo : hi + 1] - offsets[lo], MEMBERS)
        if len(found):
            ends = np.r_[0, np.cumsum(found.end - found.start)]
            array = pa.Array.from_buffers(
                pa.large_binary(), len(found), [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(part[MEMBERS[part]])]
            )
            yield array, np.cumsum(BREAKS[part])[found.start] + found.document


def shards(docs: DataFrame) -> DataFrame:
    """Automata over words of their own; a task starts a new one after so many words."""
    block = SHARD_WORDS // 2

    def count(batches):
        partition, made = TaskContext.get().partitionId(), 0
        open_shards: dict[str, Shard] = {}

        def row(lang):
            nonlocal made
            found, counts, automaton = open_shards[lang].counted()
            open_shards[lang].clear()
            made += 1
            columns = [
                pa.array([(partition << 32) + made]),
                pa.array([lang], pa.string()),
                pa.array([found.cast(pa.binary()).to_pylist()], pa.list_(pa.binary())),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([automaton], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["shard", "lang", "words", "counts", "automaton"])

        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                shard = open_shards.setdefault(lang, Shard())
                for array, pieces in tokens(batch.column("text").filter(pc.equal(langs, lang))):
                    for begin in range(0, len(array), block):
                        shard.add(array, pieces, begin, min(begin + block, len(array)))
                        if shard.size >= SHARD_WORDS:
                            yield row(lang)
        for lang, shard in open_shards.items():
            if shard.size:
                yield row(lang)

    lang = F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE)).alias("lang")
    return docs.select(lang, "text").where(F.length("text") > 0).mapInArrow(count, SHARDS)


# ---------------------------------------------------------------- counts


def _merged(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join that is never a broadcast. Spark sizes a side by its compressed files and the columns taken, or by what it was
    before an explode; of a vocabulary or of phrases that is several times too low, and the driver would hold them as a hash map."""
    return left.join(right.hint("merge"), on, how)


def vocabulary(table: DataFrame) -> DataFrame:
    """Per language and word its count, its number from 1 on in byte order, and its prefix ranges."""
    pairs = table.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("pair"))
    counted = pairs.groupBy("lang", F.col("pair.words").alias("word")).agg(F.sum("pair.counts").alias("n"))
    ranked = prefixes(
        written(counted.where("n > 0"), "words"), ["lang"], ["word"], {"rank": F.lit(1), "start": F.col("n")}
    )
    last = F.expr(f"(start + n - 1) div {RANGE_WORDS} - start div {RANGE_WORDS} + 1")
    return ranked.select(
        "lang",
        "word",
        "n",
        (F.col("rank") + 1).alias("id"),
        F.expr(f"start div {RANGE_WORDS}").alias("first"),
        F.when(F.col("n") * 4 > RANGE_WORDS, last).otherwise(1).alias("ranges"),
    )


def renamed(table: DataFrame, vocab: DataFrame, width: int) -> DataFrame:
    """The shards' automata with the vocabulary's numbers, cut into prefix ranges, ``width`` together."""
    places = table.select("shard", "lang", F.posexplode("words").alias("place", "word"))
    known = _merged(places, vocab, ["lang", "word"]).select(
        F.col("shard").alias("of_shard"), "place", "id", "first", "ranges"
    )

    def relabel(left, right):
        # A shard's last two words may be counted by another shard only; they have a place all the same.
        place = right.column("place").to_numpy()
        new = {n: np.zeros(len(left.column("words")[0]) + 1, np.int64) for n in ("id", "first", "ranges")}
        for name, column in new.items():
            column[place + 1] = right.column(name).to_numpy()
        own = automata.load(left.column("automaton")[0].as_py())
        a, b, c = (new["id"][x] for x in (own.a, own.b, own.c))
        paths = Paths(a, b, c, own.weight, new["first"][own.a], new["ranges"][own.a])
        return _messages(left.column("lang")[0].as_py(), left.column("shard")[0].as_py(), paths, width)

    return table.groupBy("shard").cogroup(known.groupBy("of_shard")).applyInArrow(relabel, MESSAGES)


def _messages(lang: str, shard: int, paths: Paths, width: int) -> pa.Table:
    parts = [(prefix, automata.dump(own)) for prefix, own in paths.split(width)]
    return pa.table(
        {
            "lang": pa.array([lang] * len(parts), pa.string()),
            "prefix": pa.array([p for p, _ in parts], pa.int64()),
            "shard": pa.array([shard] * len(parts), pa.int64()),
            "automaton": pa.array([a for _, a in parts], pa.binary()),
        }
    )


def _united(group: pa.Table) -> Paths:
    return automata.union([automata.load(a.as_py()) for a in group.column("automaton")])


def level(messages: DataFrame, pools: int, width: int) -> DataFrame:
    """Unites the automata of a prefix over pools of shards and splits them into narrower prefixes."""

    def unite(key, group):
        return _messages(key[0].as_py(), key[2].as_py(), _united(group), width)

    pool = F.pmod(F.xxhash64("shard"), F.lit(pools)).alias("pool")
    return messages.groupBy("lang", "prefix", pool).applyInArrow(unite, MESSAGES)


def phrase_counts(messages: DataFrame, least: int) -> DataFrame:
    """Counts of paths of two words (c is 0) and three, of at least ``least`` occurrences. Of a first word with
    several ranges, a two-word path is counted in parts, which are all there."""

    def count(key, group):
        paths = _united(group)
        heads, weight = paths.beginnings()
        two = (weight >= least) | (paths.ranges[heads] > 1)
        three = (paths.c > 0) & (paths.weight >= least)
        pairs, total = paths.pick(heads[two]), int(two.sum() + three.sum())
        triples = paths.pick(three)
        return pa.table(
            {
                "lang": pa.array([key[0].as_py()] * total, pa.string()),
                "a": np.r_[pairs.a, triples.a],
                "b": np.r_[pairs.b, triples.b],
                "c": np.r_[np.zeros(len(pairs), np.int64), triples.c],
                "n": np.r_[weight[two], triples.weight],
            }
        )

    return messages.groupBy("lang", "prefix").applyInArrow(count, COUNTS)


def counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The vocabulary, and the phrases of two and three words with at least ``least`` occurrences."""
    table = written(shards(docs), "shards")
    vocab = written(vocabulary(table), "vocabulary")
    ranges = (vocab.agg(F.max(F.col("first") + F.col("ranges")).alias("n")).first()["n"]) or 1
    levels = 1
    while FAN**levels < ranges:
        levels += 1
    # So many ranges are split into at each level.
    fan = 2
    while fan**levels < ranges:
        fan += 1
    messages = renamed(table, vocab, fan ** (levels - 1))
    pools = table.count()
    for depth in range(1, levels):
        pools = -(-pools // fan)
        messages = level(written(messages, "messages"), pools, fan ** (levels - 1 - depth))
    found = written(phrase_counts(messages, least), "phrases")
    whole = found.groupBy("lang", "a", "b", "c").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return vocab, written(whole, "counts")


# ---------------------------------------------------------------- scores


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE a a / (l r)), exact."""
    wide = {n: f"cast({n} as decimal(15,0))" for n in (a, left, right)}
    return F.expr(f"({wide[a]} * {wide[a]} * {SCALE}) div ({wide[left]} * {wide[right]})")


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, held: int = HELD_PERCENT) -> DataFrame:
    """Each language's ``first`` best phrases: lang, rank, phrase, a, l, r, n, score."""
    vocab, found = counts(docs, least)
    single = vocab.select("lang", "id", F.col("n").alias("own"))
    pairs = found.where("c = 0").select("lang", "a", "b", "n")
    triples = found.where("c > 0").select("lang", "a", "b", "c", "n")

    def word(label: str, name: str) -> DataFrame:
        return single.select("lang", F.col("id").alias(label), F.col("own").alias(name))

    def pair(x: str, y: str, name: str) -> DataFrame:
        return pairs.select("lang", F.col("a").alias(x), F.col("b").alias(y), F.col("n").alias(name))

    holders = [triples.select("lang", F.col(x).alias("a"), F.col(y).alias("b"), F.col("n").alias("longer")) for x, y in ("ab", "bc")]
    longest = reduce(DataFrame.unionByName, holders).groupBy("lang", "a", "b").agg(F.max("longer").alias("longer"))
    kept = _merged(pairs, longest, ["lang", "a", "b"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * held)
    )
    two = _merged(_merged(kept, word("a", "l"), ["lang", "a"]), word("b", "r"), ["lang", "b"]).select(
        "lang", "a", "b", F.lit(0).cast("long").alias("c"), "n", "l", "r", _score("n", "l", "r").alias("score")
    )
    parts = triples
    for own, labels in (
        (pair("a", "b", "l2"), ["a", "b"]), (pair("b", "c", "r1"), ["b", "c"]), (word("a", "l1"), ["a"]), (word("c", "r2"), ["c"])
    ):
        parts = _merged(parts, own, ["lang", *labels])
    parts = parts.withColumns({"s1": _score("n", "l1", "r1"), "s2": _score("n", "l2", "r2")})
    late = F.col("s2") < F.col("s1")
    three = parts.select(
        "lang", "a", "b", "c", "n",
        F.when(late, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(late, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )

    # Spark limits each task to the best before the shuffle; ties at the limit all stay until their words are known.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"))
    near = two.unionByName(three).withColumn("place", F.rank().over(best)).where(F.col("place") <= first).drop("place")
    text = vocab.select("lang", "id", F.col("word").cast("string").alias("word"))
    for label in ("a", "b", "c"):
        named = text.select("lang", F.col("id").alias(label), F.col("word").alias(f"word_{label}"))
        near = _merged(near, named, ["lang", label], "left")
    phrase = F.concat_ws(" ", "word_a", "word_b", "word_c")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"), "phrase")
    ranked = near.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    totals = vocab.groupBy("lang").agg(F.sum("n").alias("total"))
    return _merged(ranked, totals, ["lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r",
        F.col("total").alias("n"), "score",
    )

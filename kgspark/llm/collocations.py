"""Phrases of two and three words that occur together more often than their parts do.

Texts are coded in stretches of bounded size, one language each: a stretch is a row that holds its distinct words, their
counts and its text as places among them. Only a stretch's distinct words are shuffled, to learn which words are frequent in
all texts and their ids, which go by frequency. A stretch then counts its word pairs by tiles, squares of ``side`` neighbouring
frequency ranks: a dense tile adds up in one directly addressed array (``bincount``), the pairs of all sparse tiles are sorted
and run-length coded. What stretches counted is added up by pair. Frequent pairs come back to the stretches that hold them, are
ranked by frequency in their turn, and pairs of such a pair and a third word are counted in tiles by the same function.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kgspark.llm.common import cut, map_rows, ship, text_or_empty
from kgspark.llm.ranked import packed, unpacked
from kgspark.operators.ranking import positions

#: Bytes in lower case (A-Z only); line feeds stand for whatever ends a piece, blanks for what ends a word.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))


@dataclass(frozen=True)
class Settings:
    """Least occurrences of a phrase, rows a language, the size of stretches, of tiles, and the fill from which a tile is dense."""

    least: int = 10
    top: int = 2000
    inside: int = 50
    stretch: int = 8 << 20
    side: int = 1024
    dense: float = 1 / 64


# Coding

CODED = "stretch long, lang string, words array<string>, counts array<long>, codes binary"


def coded(docs: DataFrame, text_col: str, lang_col: str, settings: Settings) -> DataFrame:
    """Stretches of about ``stretch`` bytes of one language. A code is a word's place in ``words``; -1 ends a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made, open_ = TaskContext.get().partitionId() << 32, count(), {}

        def row(lang):
            names, parts, _ = open_.pop(lang)
            codes = np.concatenate(parts) - 2
            words = [x.decode("utf-8", "surrogatepass") for x in list(names)[2:]]
            values = base + next(made), lang, words, np.bincount(codes[codes >= 0], minlength=len(words)), packed(codes)
            types = pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], [x.split()[0] for x in CODED.split(", ")])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang, data = lang.as_py(), text.as_py().encode("utf-8", "surrogatepass").translate(FOLD)
                if lang not in open_:
                    names = defaultdict(count().__next__)
                    names[b""], names[b"\n"]  # the codes 0 and 1
                    open_[lang] = [names, [], 0]
                entry = open_[lang]
                parts = data.replace(b"\n", b" \n ").split(b" ")
                codes = np.fromiter(map(entry[0].__getitem__, parts), np.int32, len(parts))
                entry[1].append(np.append(codes[codes > 0], np.int32(1)))
                entry[2] += len(data)
                if sum(e[2] for e in open_.values()) >= settings.stretch:
                    yield row(max(open_, key=lambda x: open_[x][2]))
        for lang in list(open_):
            yield row(lang)

    ship(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), text_or_empty(text_col).alias("text")).mapInArrow(run, CODED)


def in_ids(stretches: DataFrame, known: DataFrame) -> DataFrame:
    """``ids``, a stretch's frequent words by frequency, and ``codes`` as places among them; -1 where a piece or an infrequent word is."""

    def rows():
        def apply(batch):
            out = {"ids": [], "codes": []}
            for raw, n, found in zip(batch["codes"], batch["n"], batch["found"], strict=True):
                found = sorted(found or [], key=lambda x: x["id"])
                new = np.full(n + 1, -1)
                new[[x["pos"] for x in found]] = np.arange(len(found))
                out["ids"].append(packed(np.array([x["id"] for x in found], np.int64)))
                out["codes"].append(packed(new[unpacked(raw)]))
            return {"stretch": batch["stretch"], "lang": batch["lang"], **out}

        return apply

    both = stretches.select("stretch", "lang", F.size("words").alias("n"), "codes").join(known, "stretch", "left")
    return map_rows(both, rows, "stretch long, lang string, ids binary, codes binary")


# Counting


def tile_counts(a: np.ndarray, b: np.ndarray, side: int, dense: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of two columns of frequency ranks, with their counts.

    Ranks are split into tiles of ``side`` times ``side`` pairs. A tile that is filled to ``dense`` or more is counted in an
    array with a place for each of its pairs, the pairs of all other tiles in sorted coordinate form.
    """
    if not len(a):
        return a, b, a
    wide = int(b.max()) // side + 1
    tile = (a // side) * wide + b // side
    size = np.bincount(tile) if tile.max() < 4 * len(tile) else None
    values, which, n = (np.arange(len(size)), tile, size) if size is not None else np.unique(tile, return_inverse=True, return_counts=True)
    heavy = n >= dense * side * side
    first, second, counts = [], [], []
    inside = heavy[which]
    if inside.any():
        at = np.flatnonzero(inside)
        at = at[np.argsort(which[at], kind="stable")]
        for part in np.split(at, np.flatnonzero(np.diff(which[at])) + 1):
            t = int(values[which[part[0]]])
            cells = np.bincount((a[part] % side) * side + b[part] % side, minlength=side * side)
            full = np.flatnonzero(cells)
            first.append(t // wide * side + full // side), second.append(t % wide * side + full % side), counts.append(cells[full])
    key, n = np.unique(a[~inside] << 32 | b[~inside], return_counts=True)
    first.append(key >> 32), second.append(key & 0xFFFFFFFF), counts.append(n)
    return np.concatenate(first), np.concatenate(second), np.concatenate(counts)


def pairs_of(stretches: DataFrame, settings: Settings) -> DataFrame:
    """``stretch``, ``key`` (two word ids in one number) and ``n``: the pairs of frequent words that follow each other."""

    def rows():
        def apply(batch):
            out = [], [], []
            for stretch, ids, codes in zip(batch["stretch"], map(unpacked, batch["ids"]), map(unpacked, batch["codes"]), strict=True):
                a, b = codes[:-1], codes[1:]
                good = (a >= 0) & (b >= 0)
                a, b, n = tile_counts(a[good], b[good], settings.side, settings.dense)
                out[0].append(np.full(len(n), stretch)), out[1].append(ids[a] << 32 | ids[b]), out[2].append(n)
            return {k: pa.array(np.concatenate(v)) for k, v in zip(("stretch", "key", "n"), out, strict=True)}

        return apply

    return map_rows(stretches.drop("lang"), rows, "stretch long, key long, n long")


def triples_of(stretches: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """``key`` (the first two words), ``third`` and ``n``: three words of which both pairs are frequent. ``pairs``: those of each stretch, with their counts in all texts."""
    side, dense = settings.side, settings.dense

    def count_in(known: pa.Table, text: pa.Table) -> pa.Table:
        made = [], [], []
        if known.num_rows and text.num_rows:
            key, total = known["key"].to_numpy(), known["total"].to_numpy()
            key = key[np.lexsort((key, -total))]  # frequent pairs by frequency
            by_key = np.argsort(key)
            ids, codes = unpacked(text["ids"][0].as_py()), unpacked(text["codes"][0].as_py())
            a, b = codes[:-1], codes[1:]
            asked = np.where((a >= 0) & (b >= 0), ids[a] << 32 | ids[b], -1) if len(ids) else np.full(len(a), -1)
            at = np.minimum(np.searchsorted(key, asked, sorter=by_key), len(key) - 1)
            pair = np.where(key[by_key[at]] == asked, by_key[at], -1)
            good = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
            p, c, n = tile_counts(pair[good], codes[good + 2], side, dense)
            made = key[p], ids[c], n
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("key", "third", "n"), made, strict=True)})

    ship(stretches.sparkSession)
    known = pairs.select("stretch", "key", "total").groupBy("stretch")
    return known.cogroup(stretches.groupBy("stretch")).applyInArrow(count_in, "key long, third long, n long")


# Scores


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly: 38 digits hold the products of counts of up to 16."""
    wide = lambda x: F.col(x).cast("decimal(16,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """Each language's ``top`` phrases of two and three words by score.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and U+000A to U+000D, words at blanks and tabs. A null language is ``und``,
    null texts are empty. ``n`` counts a language's words; a phrase of ``a`` occurrences, ``least`` or more, is scored by its
    worst cut into parts of ``l`` and ``r`` occurrences (the earliest of equal ones), floor(1000000 a a / (l r)). A pair that
    stands inside three words of at least ``inside`` hundredths of its occurrences is left out. Rank by score, ``a``, phrase.
    Returns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``. Repeated rows count each; an empty table gives
    none; other columns, whatever their names, are ignored. Word ids are 31 bits: up to 2,147,483,647 frequent words.
    """
    stretches = cut(coded(docs, text_col, lang_col, settings), "stretches")
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)
    sizes = cut(stretches.select("lang", size.alias("n")).groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    words = stretches.select("stretch", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select("stretch", "lang", "pos", F.col("col.words").alias("word"), F.col("col.counts").alias("n"))
    frequent = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= settings.least)
    frequent = cut(positions(frequent, [F.desc("f"), "lang", "word"], "id"), "words")
    known = words.join(frequent, ["lang", "word"]).groupBy("stretch").agg(F.collect_list(F.struct("pos", "id")).alias("found"))
    text = cut(in_ids(stretches, known), "coded")

    of_pair = Window.partitionBy("key")
    pairs = pairs_of(text, settings).withColumn("total", F.sum("n").over(of_pair)).withColumn("first", F.min("stretch").over(of_pair) == F.col("stretch"))
    pairs = cut(pairs.filter(F.col("total") >= settings.least).drop("n"), "pairs")  # a row for each pair and stretch that holds it
    triples = triples_of(text, pairs, settings).groupBy("key", "third").agg(F.sum("n").alias("a")).filter(F.col("a") >= settings.least)
    triples = cut(triples.withColumn("end", F.shiftleft(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), 32).bitwiseOR(F.col("third"))), "triples")
    pairs = pairs.filter("first").select("key", F.col("total").alias("a"))

    word = frequent.select("id", F.col("f"))
    low, high = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("key", 32)
    longer = triples.select("key", "a").union(triples.select("end", "a")).groupBy("key").agg(F.max("a").alias("longer"))
    two = pairs.join(longer, "key", "left").filter(F.coalesce(100 * F.col("longer") < settings.inside * F.col("a"), F.lit(True)))
    two = two.withColumn("w1", high).withColumn("w2", low).join(word.toDF("w1", "l"), "w1").join(word.toDF("w2", "r"), "w2")
    two = two.select("w1", "w2", F.lit(None).cast("long").alias("w3"), "a", "l", "r", score("a", "l", "r").alias("score"))

    three = triples.withColumn("w1", high).withColumn("w2", low).withColumnRenamed("third", "w3")
    three = three.join(word.toDF("w1", "l1"), "w1").join(pairs.toDF("end", "r1"), "end").join(pairs.toDF("key", "l2"), "key").join(word.toDF("w3", "r2"), "w3")
    cuts = [F.struct(score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.withColumn("cut", F.least(*cuts)).select("w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")

    name = frequent.select("id", "word")
    scored = cut(two.union(three).join(frequent.select(F.col("id").alias("w1"), "lang", F.col("word").alias("t1")), "w1"), "scored")
    within = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = scored.withColumn("at", F.rank().over(within)).filter(F.col("at") <= settings.top)  # ties go on to the phrase
    best = best.join(name.toDF("w2", "t2"), "w2").join(name.toDF("w3", "t3"), "w3", "left").withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3"))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(place).cast("long")).filter(F.col("rank") <= settings.top)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

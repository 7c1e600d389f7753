"""Mentions of names in texts: an alias table matched against all texts at once, the longest match first, with offsets."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of texts and aliases, and how many aliases are sent to the tasks at once; more of them are matched part by part.
WORD = "[A-Za-z0-9]+"
MOST_ALIASES, FLUSH = 200_000, 50_000


def alias_table(names: DataFrame, entity: str, alias: str) -> DataFrame:
    """(words, entity, entities): an alias as its words in lower case, joined by a space; the entity is null where it names several.

    Aliases without a word are none.
    """
    words = F.array_join(F.regexp_extract_all(F.lower(F.col(alias)), F.lit(f"({WORD})"), 1), " ")
    named = names.select(words.alias("words"), F.col(entity).alias("entity")).filter("words <> ''").distinct()
    g = named.groupBy("words").agg(F.min("entity").alias("entity"), F.countDistinct("entity").alias("entities"))
    return g.withColumn("entity", F.when(F.col("entities") == 1, F.col("entity")))


def _scan(sent):
    """At each word of a text the longest alias that begins there: (key, at, n, start, stop, words)."""
    names = ["key", "at", "n", "start", "stop", "words"]

    def rows(found) -> pa.RecordBatch:
        keys, *cells = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), *[pa.array(c, k) for c, k in zip(cells, (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()), strict=True)]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_first, word = sent.value, re.compile(WORD)
        for batch in batches:
            found = []
            for k, text in enumerate(batch.column(1)):
                spans = [(m.start(), m.end(), m.group().lower()) for m in word.finditer(text.as_py() or "")]
                said = [s[2] for s in spans]
                for at, first in enumerate(said):
                    for rest in by_first.get(first, ()):
                        n = len(rest) + 1
                        if tuple(said[at + 1 : at + n]) == rest:
                            found.append((batch.column(0).slice(k, 1), at, n, spans[at][0], spans[at + n - 1][1], " ".join(said[at : at + n])))
                            break
                if len(found) > FLUSH:
                    yield rows(found)
                    found = []
            if found:
                yield rows(found)

    return run


def mentions(texts: DataFrame, key: str, text: str, aliases: DataFrame, most: int = MOST_ALIASES) -> DataFrame:
    """(key, start, stop, words, entity): the mentions in each text, from left to right, the longest at each place, none within another.

    ``key`` tells texts apart; ``aliases`` is what ``alias_table`` gives. Offsets are
    code points, the end exclusive; an alias that names several entities is a
    mention with a null one. The aliases go to the tasks keyed by their first word, at most ``most`` of them at a time;
    each text is scanned where it lies, and only its matches are shuffled. Null texts have none.
    """
    spark = texts.sparkSession
    kind = texts.schema[key].dataType.simpleString()
    parts = -(-aliases.count() // most)
    found = None
    for part in range(parts):
        own = aliases.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == part).select("words").toLocalIterator()
        by_first: dict[str, list[tuple[str, ...]]] = {}
        for r in own:
            first, *rest = r["words"].split(" ")
            by_first.setdefault(first, []).append(tuple(rest))
        for lists in by_first.values():
            lists.sort(key=len, reverse=True)
        scanned = texts.select(F.col(key).alias("key"), text).mapInArrow(_scan(spark.sparkContext.broadcast(by_first)), f"key {kind}, at int, n int, start int, stop int, words string")
        found = scanned if found is None else found.unionByName(scanned)
    if found is None:
        return spark.createDataFrame([], f"{key} {kind}, start int, stop int, words string, entity {aliases.schema['entity'].dataType.simpleString()}")
    # Of matches at one place the longest, then the leftmost that doesn't reach into one taken before.
    matches = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", (-F.col("n")).alias("less"), "start", "stop", "words"))).alias("m"))
    kept = F.aggregate(
        "m", F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<start:int,stop:int,words:string>>").alias("taken")),
        lambda s, x: F.when(x["at"] < s["free"], s).otherwise(F.struct((x["at"] - x["less"]).alias("free"), F.array_append(s["taken"], F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["words"].alias("words"))).alias("taken"))),
        lambda s: s["taken"],
    )
    each = matches.select(F.col("key").alias(key), F.inline(kept))
    return each.join(aliases.select("words", "entity"), "words").select(key, "start", "stop", "words", "entity")

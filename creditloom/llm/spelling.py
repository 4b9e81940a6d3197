"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the forms they follow.

``word_counts`` counts the words of whole texts.  ``neighbours`` finds all pairs of words that differ
by one inserted, deleted or replaced code point.  ``forms`` names each word's form and root.

Of a pair, the shorter word (of equal ones, either) gives two disjoint chunks, its halves, and the
other all its positional grams of the halves' lengths.  One edit leaves a half as it is, and moves
it by one place at most.  The two lengths fix the shift: the first half stays, the second moves by
their difference.  Grams that no half can meet are not made, so a word is four rows: as the owner of
halves, which are also its grams for words of its own length, and as the owner of grams for words
one shorter.  What meets in a gram is verified.

A gram that more than ``crowd`` rows hold is not paired off.  Its words are equal but for the rest
beside the gram, and the rests are one edit apart if the words are: they are cut into halves in
turn, until few rows meet or a rest is one code point, so no group of words is paired whole and no
pair is lost.

Edge cases: null and empty texts have no words; a null doc_id counts as empty; repeated rows count
each; ties of count go to the smaller word in code-point order; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.sources.tables import materialise

# Fixed values.
LETTERS = re.compile("[a-zÀ-ÿ]+")
DROP_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
TIMES = 2  # a form occurs so many times as often as its variant, at least

CROWD = 32
HELD_WORDS = 200_000  # that a task adds up before it hands them on


def word_counts(docs: DataFrame, drop_every: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text), A to Z lower-cased.

    With ``drop_every``, a word loses one code point in the documents where the checksum of
    "<doc_id>:<word>" is a multiple of it.
    """
    narrow = docs.select(
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary").alias("id"),
        docs["text"].cast("string").cast("binary").alias("text"),
    ).filter("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.record_batch({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                # bytes.lower() changes A to Z alone
                found = Counter(LETTERS.findall(text.as_py().lower().decode("utf-8", "replace")))
                before = zlib.crc32(doc_id.as_py() + b":")
                for word, n in found.items():
                    if drop_every:
                        h = zlib.crc32(word.encode(), before)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    parts = narrow.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row (key, side, word, n, at, size) cut at the halves of its rest, which ``at`` and ``size`` bound.

    Side 0 owns the halves, side 1 is one code point longer and owns the grams that they may meet.
    """
    chunks = F.col("size") - F.col("side")  # the length whose halves these are
    first = F.floor(chunks / 2).cast("int")
    second = chunks - first

    def cut(slot: int, begin: Column, length: Column, at: Column, size: Column) -> Column:
        gram = F.substring("word", begin + 1, length)
        return F.struct(F.xxhash64("key", chunks, F.lit(slot), gram).alias("key"), at.alias("at"), size.alias("size"))

    end = F.col("at") + F.col("size")
    both = F.array(
        cut(0, F.col("at"), first, F.col("at") + first, F.col("size") - first),
        cut(1, end - second, second, F.col("at"), F.col("size") - second),
    )
    return rows.select("side", "word", "n", F.explode(both).alias("part")).select("part.key", "side", "word", "n", "part.at", "part.size")


def neighbours(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(x, n_x, y, n_y) of all pairs of ``words`` (word, n) that are one edit apart, each pair once."""
    sides = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = words.select(F.lit(0).cast("long").alias("key"), sides.alias("side"), "word", "n", F.lit(0).alias("at"), F.length("word").alias("size"))
    rows = rows.filter(F.col("size") > F.col("side"))
    found = []
    while True:
        rows = materialise(_halves(rows), "grams")
        # an owner meets itself among the grams of its own length, so one row alone meets nothing
        split = (F.count("*") > crowd) & (F.max(F.col("size") - F.col("side")) > 1)
        owned = (F.min("side") == 0) & (F.count("*") > 1)
        live = rows.groupBy("key").agg(owned.alias("live"), split.alias("crowded")).filter("live").drop("live")
        met = materialise(rows.join(live, "key"), "met")
        few = met.filter("not crowded")
        owner = few.filter("side = 0").select("key", F.col("word").alias("x"), F.col("n").alias("n_x"))
        other = few.select("key", "side", F.col("word").alias("y"), F.col("n").alias("n_y"))
        near = owner.join(other, "key").filter("(side = 1 or x < y) and levenshtein(x, y, 1) = 1")
        found.append(materialise(near.select("x", "n_x", "y", "n_y").distinct(), "near"))
        rows = met.filter("crowded").drop("crowded")
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, found).distinct()


def forms(words: DataFrame, near: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every one of ``words`` (word, n); ``near`` as of ``neighbours``.

    The form is the near word of largest n, if that is ``times`` the word's own at least.  As counts
    grow by that factor from form to form, a root is few steps away; each round doubles the step.
    """
    each = near.select(F.col("x").alias("word"), F.col("y").alias("other"), F.col("n_y").alias("m")).unionByName(
        near.select(F.col("y").alias("word"), F.col("x").alias("other"), F.col("n_x").alias("m"))
    )
    best = each.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    large = -F.col("best.less")
    has_form = large >= times * F.col("n")
    named = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best.other")).alias("form"), F.when(has_form, large).alias("form_n"),
    )
    named = materialise(named, "forms")
    steps = named.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(steps.join(further, "root", "left").select("word", "root", "next"), "roots")
        steps = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.filter("next is not null").isEmpty():
            break
    return named.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, drop_every: int | None = None) -> DataFrame:
    """The words of ``docs`` with their forms and roots."""
    words = materialise(word_counts(docs, drop_every), "words")
    return forms(words, neighbours(words))

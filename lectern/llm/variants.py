"""Operator 13: spelling variants, by anagram hashing.

A word's key is the sum of the fifth powers of its code points, so words of the same letters have one
key whatever their order. Taking a letter out of a word takes its power off the key: two words that
differ by one replaced letter agree in a key less one letter each, and a word with a letter more agrees,
less that letter, with the whole key of the other. So a table of keys, whole and less each distinct letter,
joined with itself, holds every key difference of one added, removed or exchanged letter; the letters'
order is then verified. No difference of two fifth powers below 256 occurs twice, so a pair is met once.

A key that more than ``LARGE`` words share is not joined as it is: its words are laid out by the place of
the letter that is taken out and by what is left, which must both agree, so that no group holds more words
than there are letters. All partners are found either way.

Words are counted before anything is shuffled, and forms are followed by doubling: each step along forms
multiplies the count by ``factor`` at least, so the chains are as long as the logarithm of the largest count.

Defined results: null and empty texts hold no words; a text without an id loses no letters to revisions;
repeated rows count each; ties between forms go to the word that is smaller in code-point order; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import WRITTEN, remove_stored, stored
from lectern.llm.components import hinted

SHORTEST, LEAST, FACTOR = 7, 2, 10
#: Words that share a key and are compared in one group; larger groups are laid out by place and remainder.
LARGE = 512
#: Keys are sums modulo this power of two, less one as a mask: words of any length have one.
_MASK = (1 << 62) - 1
_LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Revise = Callable[[Column, Column], Column]


def unrevised(doc_id: Column, word: Column) -> Column:
    return word


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case, and no other letter."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def words(docs: DataFrame, revise: Revise = unrevised, shortest: int = SHORTEST, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters, lower-cased, with at least ``shortest`` letters and ``least`` occurrences."""
    runs = F.regexp_extract_all(docs[text_col], F.lit(f"([{_LETTERS}]{{{shortest},}})"), 1)
    found = docs.select(docs[id_col].alias("doc_id"), F.explode(runs).alias("run"))
    found = found.select(revise(F.col("doc_id"), lower_ascii(F.col("run"))).alias("word")).filter(F.length("word") >= shortest)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _power(letter: Column) -> Column:
    code = F.ascii(letter).cast("long")
    return code * code * code * code * code


def keys(counted: DataFrame) -> DataFrame:
    """(word, n, key, at, less): each word's key as ``at``, and its key less each of its distinct letters."""
    spelled = counted.select("word", "n", F.split("word", "").alias("letters"))
    key = F.aggregate("letters", F.lit(0).cast("long"), lambda acc, x: (acc + _power(x)).bitwiseAND(F.lit(_MASK)))
    spelled = spelled.withColumn("key", key)
    less = F.transform(F.array_distinct("letters"), lambda x: F.struct(_without(x).alias("at"), F.lit(1).alias("less")))
    whole = F.array(F.struct(F.col("key").alias("at"), F.lit(0).alias("less")))
    return spelled.select("word", "n", "key", F.inline(F.concat(whole, less)))


def _without(letter: Column) -> Column:
    return (F.col("key") - _power(letter)).bitwiseAND(F.lit(_MASK))


def _pairs(left: DataFrame, right: DataFrame, verified: Column) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    # one letter exchanged: both keys less a letter; one added: a whole key and one less a letter
    kinds = (F.col("a.less") + F.col("b.less") == 2) & (F.length("a.word") == F.length("b.word")) & (F.col("a.word") < F.col("b.word"))
    kinds |= (F.col("a.less") == 1) & (F.col("b.less") == 0) & (F.length("a.word") == F.length("b.word") + 1)
    met = a.join(b, (F.col("a.at") == F.col("b.at")) & kinds & verified)
    return met.select(F.col("a.word").alias("u"), F.col("a.n").alias("u_n"), F.col("b.word").alias("v"), F.col("b.n").alias("v_n"))


def _laid_out(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys less a letter by each place of that letter, and whole keys, with what is left of the word.

    ``first`` tells that the letter before is another one: of equal letters side by side any leaves the same."""
    letter = lambda i: F.substr("word", i, F.lit(1))
    places = F.filter(F.sequence(F.lit(1), F.length("word")), lambda i: _without(letter(i)) == F.col("at"))
    i = F.col("place")
    taken = every.filter("less = 1").withColumn("place", F.explode(places))
    taken = taken.withColumn("rest", F.concat(F.substr("word", F.lit(1), i - 1), F.substr("word", i + 1)))
    taken = taken.withColumn("first", (i == 1) | (letter(i) != letter(F.greatest(i - 1, F.lit(1)))))
    return stored(taken, "taken"), every.filter("less = 0").withColumn("rest", F.col("word"))


def near_pairs(counted: DataFrame) -> DataFrame:
    """(u, u_n, v, v_n): each pair of words one inserted, deleted or replaced code point apart, once."""
    every = stored(keys(counted), "keys")
    large = stored(every.groupBy("at").agg(F.count("*").alias("words")).filter(F.col("words") > LARGE).select("at"), "large")
    few = hinted(large)
    # one edit leaves the first or the last three letters alone; this spares most of the distances
    same_end = (F.left("a.word", F.lit(3)) == F.left("b.word", F.lit(3))) | (F.right("a.word", F.lit(3)) == F.right("b.word", F.lit(3)))
    short = (F.length("a.word") < 6) | (F.length("b.word") < 6)
    usual = every.join(few, "at", "left_anti")
    met = _pairs(usual, usual, (same_end | short) & (F.levenshtein("a.word", "b.word", 1) == 1))
    if large.isEmpty():
        return met
    taken, whole = _laid_out(every.join(few, "at"))
    same_rest = F.col("a.rest") == F.col("b.rest")
    changed = _pairs(taken, taken, same_rest & (F.col("a.place") == F.col("b.place")))
    return met.unionByName(changed).unionByName(_pairs(taken.filter("first"), whole, same_rest))


def followed(forms: DataFrame) -> DataFrame:
    """(word, root): where forms, a table (word, form), lead in the end."""
    spark, mark = forms.sparkSession, len(WRITTEN)
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("w"), F.col("root").alias("further"))
        joined = now.join(hinted(on), F.col("root") == F.col("w"), "left")
        now = stored(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        remove_stored(spark, mark, but=WRITTEN[-1])
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, revise: Revise = unrevised, shortest: int = SHORTEST, least: int = LEAST, factor: int = FACTOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    The form is the near word that occurs most, if it does so ``factor`` times as often as the word.
    """
    counted = stored(words(docs, revise, shortest, least, id_col, text_col), "words")
    pairs = stored(near_pairs(counted), "pairs")
    ends = [pairs.select(F.col(f"{x}").alias("word"), F.struct((-F.col(f"{y}_n")).alias("n"), F.col(y).alias("word")).alias("other")) for x, y in ("uv", "vu")]
    best = ends[0].unionByName(ends[1]).groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    held = counted.join(best, "word", "left")
    is_form = -F.col("best.n") >= factor * F.col("n")
    held = stored(held.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")), "forms")
    roots = followed(held.filter("form IS NOT NULL").select("word", "form"))
    return held.join(hinted(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def lost_letter(doc_id: Column, word: Column) -> Column:
    """The revision of the registered query: of every 31st run, by a checksum of id and run, one letter is gone."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))).otherwise(word)

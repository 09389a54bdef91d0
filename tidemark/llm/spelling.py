"""Spelling variants of a corpus's words, grouped under the most frequent form, by permuterm rotations.

Two words are near if one inserted, deleted or replaced character turns one into the other. Every word gets a terminator
and all its rotations. For a word a+c+b the rotation that begins behind c is b$a followed by c: its prefix b$a skips the
edited character, and

* words that differ from it in that character alone have rotations with the same prefix: replacements;
* the word a+b, which lacks it, has b$a itself as a rotation: an insertion or a deletion.

So each rotation enters a sort twice, whole and without its last character (never without the terminator), and near
words stand next to each other: one window over the sorted keys scans the groups. As the key holds the place of the
edit, a group holds one word per letter of the alphabet and one whole rotation at most (91 rows for the letters of
``LETTERS``), however large the vocabulary; no key is hot. A group gives each of its words what it has for it, the
number of near words and the best of them, not all pairs. A replacement is found at one place only; a deletion inside a
run of equal letters would be found at each of them, so only the run's first one counts.

Words go by their rank in order of falling frequency, then of code points, so rows stay narrow and the best near word
is the least number. Rotations of a word take room and time by its length squared; beyond ``PLAIN`` letters a key is
therefore the place and four polynomial hashes of the rotation (124 bits), which numpy takes from prefix sums in time
by the length.

Defined results. Null, empty and other texts without a letter have no words; a null key counts as an empty text in the
hash of ``deleted``. Repeated rows count each time. Words without near words are their own root. No words, no rows.
Other columns are ignored whatever their names. Texts are read once, whole; occurrences are summed before the shuffle.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.ranks import kept, ranked

LETTERS = "A-Za-zÀ-ÿ"
#: Stands behind each word; must be no letter.
END = "$"
#: Letters up to which a key is the rotation itself.
PLAIN = 64


def lowered(run: Column) -> Column:
    """A to Z in lower case, other letters as they are."""
    plain = F.octet_length(run) == F.length(run)
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, string.ascii_uppercase, string.ascii_lowercase))


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, deleted: int | None = None) -> DataFrame:
    """One row ``word`` per maximal run of letters, of ``least_length`` letters or more, of every text.

    ``deleted`` puts in misspellings: where it divides the CRC-32 of `key:run`, the run loses its character at that
    number modulo its length.
    """
    # A run shorter than the least length matches nowhere, a longer one matches whole.
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("run"))
    found = found.select("key", lowered(F.col("run")).alias("word"))
    if deleted is None:
        return found.select("word")
    found = found.select("word", F.crc32(F.concat("key", F.lit(":"), F.col("word")).cast("binary")).alias("h"))
    at = (F.col("h") % F.length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return found.select(F.when(F.col("h") % deleted == 0, shorter).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least_length)


def counted(found: DataFrame, least: int = 5) -> DataFrame:
    """word, n of the words with ``least`` occurrences or more."""
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _plain_keys(words: DataFrame) -> DataFrame:
    """Keys of up to ``PLAIN`` letters, as text."""
    marked = F.concat("word", F.lit(END))
    turned = words.where(F.length("word") <= PLAIN + 1).select("id", "word", marked.alias("marked"), F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    rotation = F.concat(F.substring("marked", F.col("i") + 1, F.length("marked")), F.substring("marked", F.lit(1), F.col("i")))
    # The letter that an open rotation skips stands at place i of the word, counted from 1.
    repeats = (F.col("i") > 1) & (F.substring("word", F.col("i"), F.lit(1)) == F.substring("word", F.col("i") - 1, F.lit(1)))
    turned = turned.select("id", "word", "i", rotation.alias("rotation"), repeats.alias("repeats"))
    whole = F.when(F.length("word") <= PLAIN, F.struct(F.col("rotation").alias("key"), F.lit(False).alias("open"), F.lit(False).alias("first")))
    skipped = F.when(F.col("i") > 0, F.struct(F.substring("rotation", F.lit(1), F.length("word")).alias("key"), F.lit(True).alias("open"), (~F.col("repeats")).alias("first")))
    return turned.select("id", F.explode(F.array_compact(F.array(whole, skipped))).alias("e")).select("id", "e.*")


#: Moduli and bases of the hashes of long keys.
_HASHES = ((2147483647, 1000003), (2147483629, 1000033), (2147483587, 1000037), (2147483579, 1000039))


def _powers(base: int, n: int, p: int) -> np.ndarray:
    out, size = np.ones(n, np.uint64), 1
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(pow(base, size, p)) % np.uint64(p)
        size += more
    return out


def _hashed(plain: int):
    def hashed(parts: Iterator) -> Iterator:
        """id, key, open, first of the keys of more than ``plain`` letters."""
        for part in parts:
            for id_, word in zip(part["id"], part["word"]):
                codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
                n, whole, skipped = len(codes), [], []
                for p, base in _HASHES:
                    p_, back = np.uint64(p), np.uint64(pow(base, -1, p))
                    upto = np.concatenate([[np.uint64(0)], np.cumsum(codes * _powers(base, n, p) % p_)])
                    whole.append(int(upto[n] % p_))
                    skipped.append((upto[:n] + (upto[n] - upto[1:]) % p_ * back) % p_)
                first = np.concatenate([[True], codes[1:] != codes[:-1]])
                ends = ":".join(map(str, whole))
                for low in range(0, n + 1, 10_000):
                    at = range(low, min(n + 1, low + 10_000))
                    yield pd.DataFrame({"id": id_, "key": [f"{i}:{n}:{ends}" for i in at], "open": False, "first": False})
                    at = range(low, min(n, low + 10_000))
                    if n > plain + 1 and at:
                        yield pd.DataFrame({"id": id_, "key": [f"{i}:{n - 1}:" + ":".join(str(h[i]) for h in skipped) for i in at], "open": True, "first": first[at.start : at.stop]})

    return hashed


def keys(words: DataFrame) -> DataFrame:
    """id, key, open, first: every rotation of a word (id, word) whole, and without its last character where it has one.

    ``first`` tells of an open rotation whether the skipped letter is the first of its run of equal letters.
    """
    long = words.where(F.length("word") > PLAIN).select("id", "word").mapInPandas(_hashed(PLAIN), "id long, key string, open boolean, first boolean")
    return _plain_keys(words).unionByName(long)


def near(words: DataFrame) -> DataFrame:
    """id, n_near, best (the least id of a near word) of the words (id, word) that have near words."""
    group = Window.partitionBy("key")
    line = group.orderBy(F.col("open").desc(), "id")
    scanned = keys(words).select(
        "id", "open", "first",
        F.count("*").over(group).alias("members"),
        F.count_if("open").over(group).alias("opens"), F.count_if("first").over(group).alias("firsts"),
        F.max(F.when(~F.col("open"), F.col("id"))).over(group).alias("whole"), F.min(F.when(F.col("first"), F.col("id"))).over(group).alias("longer"),
        F.row_number().over(line).alias("place"), F.first("id").over(line).alias("top"), F.lead(F.when(F.col("open"), F.col("id"))).over(line).alias("next"),
    ).where("members > 1")
    swapped = F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("top"))
    lost = F.when(F.col("first"), F.col("whole"))
    given = scanned.select(
        "id",
        F.when(F.col("open"), F.col("opens") - 1 + lost.isNotNull().cast("bigint")).otherwise(F.col("firsts")).alias("n_near"),
        F.when(F.col("open"), F.least(swapped, lost)).otherwise(F.col("longer")).alias("best"),
    )
    return given.where("n_near > 0").groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, jumps: int) -> DataFrame:
    """word, root: where following ``forms`` (word, form) ends, for chains of up to 2^jumps steps."""
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(jumps):
        now = kept(now, "roots")
        far = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        now = now.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"))
    return now


def grouped(words: DataFrame, factor: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of ``words`` (word, n).

    A word's ``form`` is its most frequent near word if that is ``factor`` times as frequent or more. Frequencies grow
    by the factor along a chain of forms, which bounds its length and so the number of joins that find the ends.
    """
    placed = ranked(words.select("word", "n", (-F.col("n")).alias("_falling")), [], ["_falling", "word"])
    words = kept(placed.select(F.col("rank").alias("id"), "word", "n"), "words")
    other = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = words.join(near(words), "id", "left").join(other, "best", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("bigint")))
    is_form = F.col("form_n") >= F.lit(factor) * F.col("n")
    found = kept(found.select("word", "n", "n_near", F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "forms")
    spread = words.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    steps = math.floor(math.log(spread.most / spread.least, factor) + 1e-9) if spread.most else 0
    ends = roots(found.where("form is not null"), steps.bit_length())
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

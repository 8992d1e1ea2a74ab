"""Spelling variants: words one inserted, deleted or replaced letter apart, found by PartEnum signatures.

**Words.** Maximal runs of letters with A to Z in lower case, counted over all texts. As a test of itself the operator
can damage a few: where ``every`` divides the CRC-32 of ``<id>:<run>``, one letter of the run is left out.

**Signatures.** The multiset of the letters of a word is a binary vector with one dimension for each letter and each of
its occurrences. A replaced letter changes two dimensions, an inserted or deleted one changes one. The dimensions are
partitioned by letter into three parts. Vectors at a distance of two agree on at least one whole part, those at a
distance of one on at least two: so words of equal length enumerate their three single parts, and a word and those one
letter longer their three pairs of parts. One edit also leaves the first or the last half of the shorter word as it is;
which half, and its text, is part of every signature. These conditions are necessary, so the equi-join on signatures
finds every pair, and each candidate is verified by its edit distance inside the join.

**Each pair once.** A word carries a short checksum of each of its parts, and signatures are made of these checksums.
A pair that meets at several signatures is given out at the first on which it agrees, which the two checksums and the
first halves tell; nothing has to be made distinct afterwards.

**Scale.** Runs are counted before the shuffle. All later tables have a row for a word, twelve small rows for a word on
each side of the join, or a row for a pair; all of it runs in the JVM. A signature that many words share is cut by the
adaptive skew join; candidates are no rows of the plan, as the check is part of the join. Chains of forms are followed
by pointer doubling, each round a written table; a form has at least twice the count of its word, so there is no circle
and the number of rounds is below the binary logarithm of that of the largest count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.llm.common import ascii_lower, keep

RUN = "[A-Za-zÀ-ÿ]+"
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
PARTS, BITS = 3, 18
ALL = (1 << PARTS * BITS) - 1


def _mask(part: int) -> int:
    return ((1 << BITS) - 1) << part * BITS


EQUAL = [_mask(p) for p in range(PARTS)]  # one part agrees
LONGER = [ALL ^ _mask(p) for p in range(PARTS)]  # all parts but one agree


def word_counts(docs: DataFrame, shortest: int = 5, fewest: int = 3, every: int = 0, key: str = "doc_id") -> DataFrame:
    """``word`` and ``n`` of all words of at least ``shortest`` letters and ``fewest`` occurrences.

    With ``every`` above 0, runs are damaged as said above (a null id is written as nothing). Null texts have no words.
    """
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col("text"), F.lit(RUN), F.lit(0))).alias("run"))
    word = F.when(F.col("run").rlike("[A-Z]"), ascii_lower(F.col("run"))).otherwise(F.col("run"))
    runs = runs.select("id", word.alias("word"))
    if every:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = (F.col("h") % F.char_length("word")).cast("int")
        shorter = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.char_length("word")))
        runs = runs.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("word")).alias("word"))
    return runs.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= fewest)


def _checksums(word: Column) -> Column:
    """The checksums of the parts, one above the other; a part is the sorted letters that belong to it."""
    sums = []
    for part in range(PARTS):
        others = "".join(c for c in LETTERS if ord(c) % PARTS != part)
        letters = F.array_join(F.array_sort(F.split(F.translate(word, others, ""), "")), "")
        sums.append(F.shiftleft(F.crc32(letters.cast("binary")).bitwiseAND((1 << BITS) - 1), part * BITS))
    return reduce(Column.bitwiseOR, sums)


def _signatures(words: DataFrame, longer: int) -> DataFrame:
    """``sig``, ``word``, ``n`` and ``tag`` (checksums, number of the signature, half) for one side of the join.

    ``longer`` is 1 on the side where a word is the longer one of a pair of unequal lengths.
    """
    words = words.select("word", "n", _checksums(F.col("word")).alias("sums"), F.char_length("word").alias("size"))
    made = []
    for masks, size in ((EQUAL, F.col("size")), (LONGER, F.col("size") - longer)):
        half = F.floor(size / 2).cast("int")
        for side, text in ((0, F.col("word").substr(F.lit(1), half)), (1, F.col("word").substr(F.col("size") - half + 1, half))):
            for number, mask in enumerate(masks):
                sig = F.xxhash64(F.lit(masks is EQUAL), size, F.lit(side), text, F.lit(number), F.col("sums").bitwiseAND(F.lit(mask)))
                tag = F.col("sums").bitwiseOR(F.lit((number << 1 | side) << PARTS * BITS))
                made.append(F.struct(sig.alias("sig"), tag.alias("tag")))
    return words.select("word", "n", F.explode(F.array(*made)).alias("made")).select("made.sig", "made.tag", "word", "n")


def _first(differ: Column, masks: list[int]) -> Column:
    """Number of the first signature on which two words agree, from the exclusive or of their checksums."""
    last = F.lit(len(masks) - 1)
    return reduce(lambda rest, i: F.when(differ.bitwiseAND(F.lit(masks[i])) == 0, i).otherwise(rest), reversed(range(len(masks) - 1)), last)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b``, ``a_n``, ``b_n``: each pair of words at an edit distance of one, once; ``b`` is not the shorter."""
    left = _signatures(words, 0).select("sig", F.col("tag").alias("l_tag"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = _signatures(words, 1).select("sig", F.col("tag").alias("r_tag"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    differ = F.col("l_tag").bitwiseXOR(F.col("r_tag"))
    number, side = F.shiftright("l_tag", PARTS * BITS + 1), F.shiftright("l_tag", PARTS * BITS).bitwiseAND(1)
    same_size = F.char_length("a") == F.char_length("b")
    half = F.floor(F.char_length("a") / 2).cast("int")
    once = (
        (differ.bitwiseAND(F.lit(~ALL)) == 0)
        & (~same_size | (F.col("a") < F.col("b")))
        & (number == F.when(same_size, _first(differ, EQUAL)).otherwise(_first(differ, LONGER)))
        & ((side == 0) | (F.col("a").substr(F.lit(1), half) != F.col("b").substr(F.lit(1), half)))
    )
    left, right = left.alias("l"), right.alias("r")
    return left.join(right, (F.col("l.sig") == F.col("r.sig")) & once & (F.levenshtein("a", "b", 1) == 1)).select("a", "b", "a_n", "b_n")


def forms(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word``, ``n_near``, ``form``, ``form_n`` of the words that have a near word.

    The form is the near word of the largest count (ties: the smallest in code-point order), where that is at least
    ``factor`` times the word's own; else null.
    """
    ways = (("a", "b"), ("b", "a"))
    both = near_pairs(words).select(F.explode(F.array(*[F.struct(*[F.col(c).alias(n) for c, n in ((w, "word"), (f"{w}_n", "n"), (o, "near"), (f"{o}_n", "near_n"))]) for w, o in ways])).alias("p"))
    choice = F.when(F.col("p.near_n") >= factor * F.col("p.n"), F.struct((-F.col("p.near_n")).alias("less"), F.col("p.near").alias("near")))
    best = both.groupBy(F.col("p.word").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(choice).alias("best"))
    return best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a form: forms followed to the last, by pointer doubling."""
    links = keep(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = keep(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "links")
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(docs: DataFrame, shortest: int = 5, fewest: int = 3, factor: int = 2, every: int = 0) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of the table.

    ``root`` is the word itself where it has no form, ``n_near`` 0 where nothing is near. Repeated rows count each; other
    columns are ignored; null and empty texts have no words, and an empty table gives no rows.
    """
    words = keep(word_counts(docs, shortest, fewest, every), "words")
    formed = keep(forms(words, factor), "forms")
    whole = words.join(formed, "word", "left").join(roots(formed), "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")

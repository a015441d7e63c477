"""Free-entered values to the entries of a reference list, by a prefix-filter set-similarity join.

Distinct values are normalised (case, accents, digits typed for letters, separators) and read with and
without the descriptive words at their ends. Which words are descriptive is learnt from the values: those
that stand beside ``COMPANY`` different words of the list and are no writing of one, besides numbers and
single letters; a list of them can be passed instead. A reading is the set of its words' characters and
bigrams, word ends included, whatever the order of the words. Tokens are ordered by their rarity over all
values and names; only the rare prefixes that the Jaccard bound leaves are joined, under length and
positional filters; Jaccard is then computed exactly, and the name of the highest is what the value means.
Names of other components take part as rivals: a value that is nearer to one of them means none of its own.

Defined results: null and blank values are no mentions; a value without letters means none; of equally
near names the own component's wins, then the lower ref_id; an empty reference list maps everything to
none; texts of any length are compared whole; repeated values count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from griyaflow.functions.keys import blank_to_null
from griyaflow.runtime import stored

#: Least Jaccard of a value and what it means.
THRESHOLD = 0.51
#: Different words of the list beside which a descriptive word is found, and largest share of letters in which a writing differs from its word.
COMPANY, WRITING = 6, 0.34
#: Words that make up one in so many of all words may be descriptive: at most so many.
OFTEN = 10_000
#: The reference list is a parameter table; a longer one is refused.
MOST_NAMES = 100_000
SALT = 8
COMPONENTS = ("atap", "dinding", "lantai")
# Words that stand for "nothing entered".
NOTHING = ("nan", "none", "null", "na", "unknown")
ACCENTS = ("áàâäãéèêëíìîïóòôöõúùûüñç", "aaaaaeeeeiiiiooooouuuunc")
LEET = ("0134578 9", "oieastb g")
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
#: Codes of a character: 0 stands before a word, the last after it.
_N = len(ALPHABET) + 2


def plain_text(col: Column) -> Column:
    """Lower-case words of letters and digits, one space between."""
    low = F.translate(F.lower(col), *ACCENTS)
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def _letters(words: Column) -> Column:
    """Digits read as the letters that they stand for, words without letters left out."""
    return F.transform(F.filter(words, lambda w: w.rlike("[a-z]")), lambda w: F.translate(w, *LEET))


def readings(words: Column, descriptive: list[str], most: int) -> Column:
    """The words as they are, without the descriptive ones after them, and without those before them, all or all but up to
    ``most``, the words of the longest name: it may itself begin with such words."""
    known = F.array(*[F.lit(w) for w in descriptive]).cast("array<string>")
    other = F.transform(words, lambda w: ~(F.array_contains(known, w) | w.rlike(r"^(\d+|.)$")))
    first, last, n = F.array_position(other, True).cast("int"), F.array_position(F.reverse(other), True).cast("int"), F.size(words)
    lead, end = F.when(first == 0, 0).otherwise(first - 1), F.when(last == 0, n).otherwise(n - last + 1)
    begins = F.array_union(F.array(F.lit(0)), F.sequence(F.greatest(F.lit(0), lead - most), lead))
    return F.array_distinct(F.flatten(F.transform(begins, lambda at: F.array(F.slice(words, at + 1, F.greatest(F.lit(0), end - at)), F.slice(words, at + 1, n - at)))))


def _codes(words: str) -> Column:
    """Distinct token codes of a column of words: c1 * N for a character, c1 * N + c2 for two, ends included."""
    char = f"locate(substr(w, i, 1), '{ALPHABET}')"
    one = f"transform(sequence(1, length(w)), i -> {char} * {_N})"
    two = f"transform(sequence(0, length(w)), i -> CASE WHEN i = 0 THEN 0 ELSE {char} END * {_N} + CASE WHEN i = length(w) THEN {_N - 1} ELSE locate(substr(w, i + 1, 1), '{ALPHABET}') END)"
    return F.expr(f"array_distinct(flatten(transform({words}, w -> concat({one}, {two}))))")


def descriptive_words(words: DataFrame, known: list[str]) -> list[str]:
    """Descriptive words of (v, words), v telling values apart: see above. ``known``: the words of the list."""
    each = words.select("v", F.explode(F.array_distinct("words")).alias("w"))
    listed = words.sparkSession.createDataFrame([(w,) for w in known], "w string")
    beside = each.join(F.broadcast(listed), "w").select("v", F.col("w").alias("near"))
    total = each.count()
    often = each.groupBy("w").count().filter(F.col("count") >= max(COMPANY, -(-total // OFTEN))).select("w")
    company = each.join(F.broadcast(often), "w").join(beside, "v").filter("w <> near").groupBy("w").agg(F.count_distinct("near").alias("n")).filter(F.col("n") >= COMPANY)
    own = F.exists(F.array(*[F.lit(w) for w in known]).cast("array<string>"), lambda k: F.levenshtein("w", k) <= F.lit(WRITING) * F.greatest(F.length("w"), F.length(k)))
    return sorted({r["w"] for r in company.filter(~own).select("w").collect()} | set(COMPONENTS))


def material_mentions(df: DataFrame, id_col: str = "rec_id") -> DataFrame:
    """(id, image_pos, component, value) of every non-blank material of the images."""
    # the three fields' arrays side by side: a scan reads no other field of the pictures
    images = df.select(id_col, F.posexplode(F.arrays_zip(*[F.col(f"images.material_{c}") for c in COMPONENTS])).alias("image_pos", "i"))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.col(f"i.material_{c}").alias("value")) for c in COMPONENTS]))
    return images.select(id_col, "image_pos", each.alias("m")).select(id_col, "image_pos", "m.*").filter(blank_to_null(F.col("value")).isNotNull())


def reference_names(ref: DataFrame) -> DataFrame:
    """(ref_id, component, name, words) of labels and other names."""
    names = F.array_union(F.array("label"), F.coalesce("other_names", F.array().cast("array<string>")))
    flat = ref.select("ref_id", "component", F.explode(names).alias("name")).filter(blank_to_null(F.col("name")).isNotNull())
    return flat.withColumn("words", _letters(F.split(plain_text(F.col("name")), " "))).filter(F.size("words") > 0)


def _ranked(df: DataFrame, order: list[int], threshold: float) -> DataFrame:
    """Tokens as rarity ranks, rarest first, with the set size and the prefix length of the bound."""
    ranks = F.array_sort(F.transform("codes", lambda c: F.element_at(F.lit(order), c + 1)))
    n = F.size("ranks")
    return df.withColumn("ranks", ranks).withColumn("n", n).filter("n > 0").withColumn("p", (F.col("n") - F.ceil(F.col("n") * F.lit(threshold)) + 1).cast("int")).drop("codes")


def canonical_map(values: DataFrame, ref: DataFrame, threshold: float = THRESHOLD, descriptive: list[str] | None = None) -> DataFrame:
    """(component, value, ref_id, name, jaccard) for distinct (component, value); ref_id 0 means none. ``descriptive``: words that
    say nothing of the meaning; learnt from the values where none are given."""
    names = stored(reference_names(ref).withColumn("codes", _codes("words")), "names")
    listed = names.select("words").limit(MOST_NAMES + 1).collect()
    if len(listed) > MOST_NAMES:
        raise ValueError(f"the reference list has more than {MOST_NAMES} names")
    text = plain_text(F.col("value"))
    worded = values.withColumn("t", text).filter(~F.col("t").isin(*NOTHING)).select("component", "value", F.split("t", " ").alias("words"))
    if descriptive is None:
        descriptive = descriptive_words(worded.select(F.xxhash64("component", "value").alias("v"), "words"), sorted({w for r in listed for w in r["words"]}))
    most = max((len(r["words"]) for r in listed), default=0)
    forms = worded.select("component", "value", F.explode(F.array_distinct(F.transform(readings(F.col("words"), descriptive, most), _letters))).alias("words"))
    forms = forms.withColumn("codes", _codes("words")).drop("words")
    # rarity over all values and names; there are at most _N ** 2 tokens
    counts = forms.select(F.explode("codes").alias("c")).unionByName(names.select(F.explode("codes").alias("c"))).groupBy("c").count().collect()
    order = [0] * (_N * _N)
    for rank, (code, _) in enumerate(sorted(counts, key=lambda r: (r["count"], r["c"]))):
        order[code] = rank
    left = _ranked(forms, order, threshold).withColumn("tok", F.explode(F.expr("slice(ranks, 1, p)")))
    right = _ranked(names, order, threshold).withColumn("tok", F.explode(F.expr("slice(ranks, 1, p)")))
    right = right.select("tok", "ref_id", F.col("component").alias("r_component"), "name", F.col("ranks").alias("r_ranks"), F.col("n").alias("r_n"))
    t = F.lit(threshold)
    need = F.ceil(t / (t + 1) * (F.col("n") + F.col("r_n")))
    upto = lambda n, ranks: F.col(n) - F.array_position(ranks, F.col("tok")) + 1
    pairs = left.join(right, "tok").filter((F.col("r_n") >= t * F.col("n")) & (F.col("n") >= t * F.col("r_n")))
    pairs = pairs.filter(F.least(upto("n", "ranks"), upto("r_n", "r_ranks")) >= need)
    pairs = pairs.withColumn("common", F.array_intersect("ranks", "r_ranks")).filter("common[0] = tok")  # each pair once, at its rarest common token
    pairs = pairs.withColumn("jaccard", F.size("common") / (F.col("n") + F.col("r_n") - F.size("common"))).filter(F.col("jaccard") >= t)
    own = F.col("component") == F.col("r_component")
    best = F.min(F.struct((-F.col("jaccard")).alias("j"), (~own).alias("rival"), F.col("ref_id").alias("id"), "name")).alias("b")
    chosen = pairs.groupBy("component", "value").agg(best).filter(~F.col("b.rival"))
    found = chosen.select("component", "value", F.col("b.id").alias("ref_id"), "b.name", (-F.col("b.j")).alias("jaccard"))
    return values.join(found, ["component", "value"], "left").withColumn("ref_id", F.coalesce("ref_id", F.lit(0)))


def canonical_mentions(df: DataFrame, ref: DataFrame, id_col: str = "rec_id") -> tuple[DataFrame, DataFrame]:
    """Mentions (id, image_pos, component, value, ref_id) that are no label as they stand, and the map of their values with counts."""
    mentions = material_mentions(df, id_col)
    labels = ref.select("component", F.col("label").alias("value")).distinct()
    counted = mentions.groupBy("component", "value").agg(F.count("*").alias("n_mentions"))
    values = stored(counted.join(labels, ["component", "value"], "left_anti"), "values")
    mapped = stored(canonical_map(values, ref), "map")
    salted = mapped.select("component", "value", "ref_id", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    spread = mentions.withColumn("salt", F.pmod(F.xxhash64(id_col), F.lit(SALT)).cast("int"))
    return spread.join(salted, ["component", "value", "salt"]).drop("salt"), mapped

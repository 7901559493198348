"""Benchmark decontamination by spaced-seed hashing, DataFrame operations only.

A mask is a pattern of used and ignored token places.  Every place of every
benchmark item and of every document gives one hash per mask over the used
places, so a window with substituted words at ignored places still hits.
Lengths at which some allowed choice of substituted words would leave no mask
intact (found by going through all choices: with the given masks items below
nine words and those of ten) get masks of that very length in place of the
general ones, one of which every allowed choice leaves intact.
The item side is broadcast if its counted size is within a bound (else both
sides are shuffled by hash).  Only document places that hit leave the scan,
each with the token hashes around it.

A hit is verified on its alignment: the passage is an overlap if some run of
``min_words`` aligned places that holds the hit (the whole item if that is
shorter) has at least ``similarity`` equal words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import Scratch, broadcast_if_small, fresh

#: Words of a document handled as one row, and the words that neighbouring
#: rows share, so that every hit has its surroundings in one of them.
SEGMENT = 4096
#: Hashes of the benchmark up to which it is broadcast (about 40 bytes each).
BROADCAST_ROWS = 2_000_000


@dataclass(frozen=True)
class SeedRules:
    #: 1: the word takes part, 0: it is ignored.
    masks: tuple[str, ...] = ("1101011", "11100101", "110010011")
    min_words: int = 13
    similarity: float = 0.8
    #: Items of fewer words are not looked for (1: all items with a word).
    least_item_words: int = 1

    def __post_init__(self):
        if any(m[0] != "1" or m[-1] != "1" or set(m) - {"0", "1"} for m in self.masks):
            raise ValueError("a mask starts and ends with 1")
        if max(map(len, self.masks)) > self.min_words:
            raise ValueError("a mask is no longer than the shortest overlap")
        if not 0 < self.similarity <= 1:
            raise ValueError("similarity lies above 0, up to 1")

    def substitutions(self, length: int) -> int:
        """Words of an overlap of this length that may differ."""
        return length - math.ceil(length * self.similarity - 1e-9)


@cache
def missed(rules: SeedRules, length: int) -> bool:
    """Whether some allowed substitution in an overlap of this length leaves
    no general mask intact."""
    placed = [{i + u for u, c in enumerate(m) if c == "1"} for m in rules.masks for i in range(length - len(m) + 1)]
    return any(all(p & set(changed) for p in placed) for changed in combinations(range(length), rules.substitutions(length)))


def own_masks(rules: SeedRules, length: int) -> list[str]:
    """Masks over a whole overlap of this length, one of which stays intact
    whatever words are substituted: places are dealt to classes in turn, and
    each mask ignores one class of three (one substitution) or uses one class
    of k + 1 (k substitutions)."""
    k = rules.substitutions(length)
    if k == 0:
        return ["1" * length]
    if k == 1:
        masks = ["".join("0" if i % 3 == r else "1" for i in range(length)) for r in range(3)]
    else:
        masks = ["".join("1" if i % (k + 1) == r else "0" for i in range(length)) for r in range(k + 1)]
    return [m for m in dict.fromkeys(masks) if "1" in m]


def _own(rules: SeedRules, length: int) -> list[tuple[str, int]]:
    """Those masks with their numbers."""
    return [(m, 1000 * length + r) for r, m in enumerate(own_masks(rules, length))]


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-cased words of a text, in order (null: none)."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[ \\t\\n\\x0b\\f\\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(words: Column, mask: str, number: int) -> Column:
    """Hashes of every place of one mask; places that run over the end: none."""
    used = [i for i, c in enumerate(mask) if c == "1"]
    last = F.size(words) - len(mask)
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(number), *[F.get(words, i + u) for u in used]))


def item_seeds(benchmark: DataFrame, rules: SeedRules) -> tuple[DataFrame, DataFrame]:
    """Items (item_id, item) and their seeds (h, item_no, ipos).

    Items of a length (``min_words`` for longer ones) at which the general
    masks miss an allowed substitution get the masks of that length."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(benchmark["text"]).alias("item")).where(F.size("item") >= rules.least_item_words).distinct()
    items = items.withColumn("item_no", F.xxhash64("item_id", "item"))
    length = F.least(F.size("item"), F.lit(rules.min_words))
    special = [n for n in range(rules.least_item_words, rules.min_words + 1) if missed(rules, n)]
    general = items.where(~length.isin(special)) if special else items
    seeds = None
    for number, mask in enumerate(rules.masks):
        one = general.select("item_no", F.posexplode(_seeds(F.col("item"), mask, number)).alias("ipos", "h"))
        seeds = one if seeds is None else seeds.unionAll(one)
    for n in special:
        own = F.concat(*[F.transform(_seeds(F.col("item"), m, i), lambda h, at: F.struct(at.alias("ipos"), h.alias("h"))) for m, i in _own(rules, n)])
        seeds = seeds.unionAll(items.where(length == n).select("item_no", F.inline(own)))
    return items, seeds.select("h", "item_no", "ipos")


def _document_seeds(docs: DataFrame, rules: SeedRules, special: list[int]) -> DataFrame:
    """(doc_id, words, h, at): a row per place and mask (the general ones and
    those of the ``special`` lengths); ``words`` are those of its segment."""
    lap = 2 * rules.min_words + max(map(len, rules.masks))
    w = docs.select(F.col("doc_id"), word_hashes(docs["text"]).alias("w"))
    last = F.greatest(F.floor((F.size("w") - lap) / SEGMENT), F.lit(0)).cast("int")
    segs = w.select("doc_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("w", k * SEGMENT + 1, F.lit(SEGMENT + lap)))).alias("words"))
    masks = [(m, i) for i, m in enumerate(rules.masks)] + [m for n in special for m in _own(rules, n)]
    arrays = F.array(*[_seeds(F.col("words"), m, i) for m, i in masks])
    rows = segs.select("doc_id", "words", F.explode(arrays).alias("hashes"))
    return rows.select("doc_id", "words", F.posexplode("hashes").alias("at", "h"))


def overlaps(docs: DataFrame, benchmark: DataFrame, rules: SeedRules = SeedRules()) -> DataFrame:
    """(doc_id, item_id): the verified overlaps, each once."""
    scratch = Scratch(docs.sparkSession, "decontam")
    items, seeds = item_seeds(benchmark, rules)
    items = scratch.save(items, "items")
    seeds = scratch.save(seeds.distinct(), "seeds")
    n_seeds = seeds.count()
    span = max(map(len, rules.masks))
    lengths = items.select(F.least(F.size("item"), F.lit(rules.min_words))).distinct().collect()  # at most min_words values
    places = _document_seeds(docs, rules, sorted(r[0] for r in lengths if missed(rules, r[0])))
    keys = seeds.select(F.col("h").alias("_h"), "item_no", "ipos")
    hits = places.join(broadcast_if_small(keys, n_seeds, BROADCAST_ROWS), F.col("h") == F.col("_h"))
    # the words around the hit, and the place in them that aligns with item place ipos
    side = rules.min_words
    start = F.greatest(F.col("at") - side, F.lit(0))
    near = hits.select("doc_id", "item_no", "ipos", (F.col("at") - start).alias("hit"), F.slice("words", start + 1, F.lit(2 * side + span)).alias("near"))
    near = near.distinct()
    it = items.select(F.col("item_no").alias("_no"), "item_id", "item")
    pair = near.join(broadcast_if_small(it, items.count(), BROADCAST_ROWS // 100), F.col("item_no") == F.col("_no"))
    # aligned places: near[j] against item[j - hit + ipos]
    shift = F.col("ipos") - F.col("hit")
    lo = F.greatest(F.lit(0), -shift)
    hi = F.least(F.size("near"), F.size("item") - shift) - 1
    equal = F.transform(F.sequence(lo, hi), lambda j: F.when(F.get(F.col("near"), j) == F.get(F.col("item"), j + shift), F.lit(1)).otherwise(F.lit(0)))
    length = F.least(F.lit(rules.min_words), F.size("item"))
    pair = pair.select("doc_id", "item_id", equal.alias("equal"), length.alias("length"), (F.col("hit") - lo).alias("hit"))
    # runs that hold the hit's first place
    first = F.greatest(F.lit(0), F.col("hit") - F.col("length") + 1)
    final = F.least(F.col("hit"), F.size("equal") - F.col("length"))
    need = F.ceil(F.col("length") * F.lit(rules.similarity) - F.lit(1e-9))
    runs = F.when(final >= first, F.sequence(first, final)).otherwise(F.expr("cast(array() as array<int>)"))
    found = F.exists(runs, lambda r: F.aggregate(F.slice(F.col("equal"), r + 1, F.col("length")), F.lit(0), lambda a, x: a + x) >= need)
    return pair.where(found).select("doc_id", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, rules: SeedRules = SeedRules()) -> DataFrame:
    """(doc_id, contaminated, n_items, items): one row per distinct doc_id;
    ``items`` are the overlapping item_ids, ascending.

    Null and empty texts overlap nothing; a doc_id that several rows repeat
    is contaminated if one of them is, and so are rows without a doc_id taken
    together; items that repeat are reported once per item_id (null item_ids
    count in ``contaminated`` but are not listed); other columns are ignored;
    an empty benchmark contaminates nothing.  Items of fewer than five words
    allow no substitution: they are found where all their words stand.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    found = overlaps(src, benchmark, rules).groupBy(F.col("doc_id").alias("_doc")).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    ids = src.select("doc_id").distinct()
    out = ids.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    return out.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.size(F.coalesce("items", F.expr("cast(array() as array<bigint>)"))).cast("long").alias("n_items"), F.coalesce("items", F.expr("cast(array() as array<bigint>)")).alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, rules: SeedRules = SeedRules()) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text overlaps no item.

    The verdict belongs to the text (known by its hash), so repeated and null
    doc_ids need no rule."""
    key = F.xxhash64(F.col("text").cast("string"))
    src = docs.select(key.alias("doc_id"), F.col("text"))
    scratch = Scratch(docs.sparkSession, "decontam-docs")
    found = scratch.save(overlaps(src, benchmark, rules).select(F.col("doc_id").alias(fresh(docs, "_text"))).distinct(), "found")
    return docs.join(broadcast_if_small(found, found.count(), BROADCAST_ROWS), key == found[found.columns[0]], "left_anti")

"""Document fingerprints: closed syncmers, with DataFrame functions only.

A text becomes tokens: runs of non-space characters, cut after TOKEN_CHARS
characters.  Each pair of neighbouring tokens has a hash.  A window of five
neighbouring pairs (six tokens) is chosen when the smallest of its five
hashes lies at its first or last place.  Whether a window is chosen depends
on its own six tokens alone, so an edit disturbs only the windows that
overlap it, and the same passage gives the same anchors wherever it stands.

Limit: tokens are cut on a grid from the start of each run of non-space.  In
scripts without spaces and in long unspaced strings, a character put in or
taken out moves all later cuts of the run, and a passage inside a run keeps
its anchors only where its place differs by a multiple of TOKEN_CHARS.

Defined results: NULL text counts as empty and has no anchors; a text of
fewer than six tokens has one anchor, of all its tokens; where no window is
chosen (six to eight tokens), the one with the smallest anchor is.  So only a
text without tokens has none.  Two empty fingerprints have likeness 1, an
empty and another one 0.  Ids are integers; NULL comes first.  ``with_next``
reads the id and the text alone, whatever other columns are called;
``with_fingerprint`` and ``with_positions`` replace a column named like their
result and pass the others.  An empty table gives no rows.  All rows of one
repeated id are one group, that is one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN_CHARS, TOKENS, INNER = 4, 6, 5
#: Rows that one group of neighbouring ids holds, and the groups at most (more rows then share one).
GROUP_ROWS, GROUPS = 4000, 10_000


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the text's distinct anchors (array<int>) in order
    of their first place."""
    h, p = f"_{out}_h", f"_{out}_p"
    df = df.withColumn(h, F.transform(F.regexp_extract_all(F.col(text), F.lit(r"(\S{1,%d})" % TOKEN_CHARS)), lambda t: F.xxhash64(t)))
    return _from_pairs(_pairs(df, h, p), p, h, out).drop(h, p)


def _pairs(df: DataFrame, h: str, p: str) -> DataFrame:
    """Hashes of neighbouring tokens."""
    n = F.size(h)
    return df.withColumn(p, F.zip_with(F.slice(h, 1, F.greatest(n - 1, F.lit(0))), F.slice(h, 2, F.greatest(n - 1, F.lit(0))),
                                       lambda a, b: F.xxhash64(a, b)))


def _closed(p: str, i: Column) -> Column:
    """Whether the window at pair ``i`` has its smallest hash at an edge."""
    at = [F.get(F.col(p), i + j) for j in range(INNER)]
    return F.least(at[0], at[INNER - 1]) <= F.least(*at[1:INNER - 1])


def _anchor(p: str, i: Column) -> Column:
    return F.hash(F.get(F.col(p), i), F.get(F.col(p), i + 2), F.get(F.col(p), i + 4))


def _from_pairs(df: DataFrame, p: str, h: str, out: str) -> DataFrame:
    chosen = F.filter(F.transform(F.sequence(F.lit(0), F.size(p) - INNER), lambda i: F.when(_closed(p, i), _anchor(p, i))),
                      lambda x: x.isNotNull())
    df = df.withColumn(out, F.when(F.size(p) >= INNER, F.array_distinct(chosen))
                       .when(F.size(h) > 0, F.array(F.hash(F.col(h)))).otherwise(F.array().cast("array<int>")))
    return df.withColumn(out, F.when((F.size(out) == 0) & (F.size(p) >= INNER), F.array(_least(p)["anchor"])).otherwise(F.col(out)))


def _least(p: str) -> Column:
    """The window with the smallest anchor (anchor, position)."""
    return F.array_min(F.transform(F.sequence(F.lit(0), F.size(p) - INNER),
                                   lambda i: F.struct(_anchor(p, i).alias("anchor"), i.alias("position"))))


def with_positions(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: array<struct<position, anchor>> for positional
    matching; positions count tokens from 0."""
    h, p = f"_{out}_h", f"_{out}_p"
    df = df.withColumn(h, F.transform(F.regexp_extract_all(F.col(text), F.lit(r"(\S{1,%d})" % TOKEN_CHARS)), lambda t: F.xxhash64(t)))
    df = _pairs(df, h, p)
    df = df.withColumn(out, F.when(F.size(p) >= INNER, F.transform(
        F.filter(F.sequence(F.lit(0), F.size(p) - INNER), lambda i: _closed(p, i)),
        lambda i: F.struct(i.alias("position"), _anchor(p, i).alias("anchor")))).when(
        F.size(h) > 0, F.array(F.struct(F.lit(0).alias("position"), F.hash(F.col(h)).alias("anchor")))).otherwise(
        F.array().cast("array<struct<position:int,anchor:int>>")))
    one = F.array(F.struct(_least(p)["position"].alias("position"), _least(p)["anchor"].alias("anchor")))
    return df.withColumn(out, F.when((F.size(out) == 0) & (F.size(p) >= INNER), one).otherwise(F.col(out))).drop(h, p)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, 1.0).otherwise(both / union.cast("double"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, fingerprint`` of every row beside ``next_text`` and
    ``next_fingerprint`` of the row that follows by (id, text); after the last
    comes the first.  A NULL id comes before all others.  NULL text: empty.

    Ids are dealt to groups of neighbours by approximate quantiles; the first
    row of each group is also sent to the group before.  The text is shuffled
    once, and no task sees more than its groups."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = rows.count()
    groups = min(GROUPS, max(1, n // GROUP_ROWS))
    cuts = rows.agg(F.percentile_approx("id", [(i + 1) / groups for i in range(groups - 1)] or [0.5], 10 * GROUPS)).first()[0] if n else None
    bounds = sorted(set(cuts or [])) if groups > 1 else []
    rows = rows.withColumn("grp", _group(F.col("id"), bounds))
    firsts = {r.grp: r.first for r in rows.groupBy("grp").agg(F.min(F.struct(F.col("id").isNotNull(), "id")).alias("f"))
              .select("grp", F.col("f.id").alias("first")).collect()}  # a row per group
    order = sorted(firsts)
    before = {g: order[i - 1] for i, g in enumerate(order)}
    first_ids = F.lit([firsts.get(g) if firsts.get(g) is not None else -1 for g in range(len(bounds) + 1)]).cast("array<bigint>")
    none = F.lit([g in firsts and firsts[g] is None for g in range(len(bounds) + 1)])
    target = F.lit([before.get(g, 0) for g in range(len(bounds) + 1)]).cast("array<int>")
    leads = F.when(F.get(none, F.col("grp")), F.col("id").isNull()).otherwise(F.get(first_ids, F.col("grp")) == F.col("id"))
    place = F.struct(F.col("grp").alias("grp"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(target, F.col("grp")).alias("grp"), F.lit(True).alias("guest"))
    dealt = (rows.select("id", "text", F.explode(F.when(leads, F.array(place, guest)).otherwise(F.array(place))).alias("at"))
             .select("id", "text", "at.grp", "at.guest").repartition("grp"))
    marked = with_fingerprint(dealt, "text", "fingerprint")
    follow = Window.partitionBy("grp").orderBy("guest", F.col("id").asc_nulls_first(), "text")
    return (marked.withColumn("next_text", F.lead("text").over(follow)).withColumn("next_fingerprint", F.lead("fingerprint").over(follow))
            .where("NOT guest").select(F.col("id").alias(id_col), "text", "fingerprint", "next_text", "next_fingerprint"))


def _group(x: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``x`` (NULL: 0), in two
    steps of about the root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    every = F.lit(bounds).cast("array<bigint>")
    coarse = F.size(F.filter(F.lit(bounds[::step]).cast("array<bigint>"), lambda b: b <= x))
    fine = F.size(F.filter(F.slice(every, (F.greatest(coarse, F.lit(1)) - 1) * step + 1, F.lit(step)), lambda b: b <= x))
    return F.when(x.isNull() | (coarse == 0), 0).otherwise((coarse - 1) * step + fine)


def edited(df: DataFrame) -> DataFrame:
    """``df`` with n_chars and ``edited``: the last quarter of the text's code
    points replaced by as many of the next text's first ones."""
    m = F.floor(F.col("n_chars") / 4).cast("int")
    return df.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - m).cast("int")), F.substring("next_text", F.lit(1), m)))

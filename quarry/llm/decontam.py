"""Benchmark decontamination by spaced seeds.

Tokens are the letter-and-digit runs of the lower-cased text. A mask names the
token offsets that a seed reads and, between them, those it ignores, so a seed
still matches when an ignored token was substituted. The hashes of all masked
windows of the training texts are joined to those of the benchmark items; every
hit (text, item, diagonal) is verified token by token along its diagonal: the
pair counts as contaminated if some ``window`` consecutive aligned tokens agree
in at least ``agree`` of them (for a shorter overlap in the same share of it,
rounded up, if the whole item lies in the text).

The masks miss no pair that the rule of 10 in 13 accepts: every placement of
three substitutions in 13 tokens leaves all tokens of some mask, and items whose
length would escape them have shorter masks of their own, which the texts are
read through only if the benchmark has items of that length.

All work is DataFrame expressions. Defined results: null text has no tokens;
items of fewer tokens than ``Params.shortest`` match nothing; a null doc_id or
item_id takes no part; repeated rows give the pair once; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quarry.llm.store import id_text, keep

#: Offsets that each seed reads. The first is solid, the others skip positions.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 8, 9),
         (0, 1, 2, 6, 9, 10), (0, 1, 2, 5, 6, 7), (0, 1, 2, 4, 6, 8), (0, 1, 4, 5, 6, 7))
#: Masks for whole items of so many tokens, beside those above.
SHORT = {1: ((0,),), 2: ((0, 1),), 3: ((0, 1, 2),), 4: ((0, 1, 2, 3),), 5: ((0, 1, 2), (0, 1, 3)),
         6: ((0, 1, 2, 3), (0, 1, 3, 4)), 7: ((0, 1, 2, 3), (0, 1, 3, 4)),
         9: ((0, 1, 2, 4), (0, 3, 4, 5)), 10: ((0, 1, 2, 4), (0, 3, 4, 5))}


@dataclass
class Params:
    window: int = 13
    agree: int = 10
    shortest: int = 6  # tokens of the shortest item that is looked for
    broadcast_seeds: int = 2_000_000  # up to so many benchmark seeds (24 bytes each) are broadcast, more are shuffled


def tokens(text) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")


def short_masks(lengths) -> dict:
    """mask -> lengths of the items that need it, of those in ``lengths``."""
    need: dict = {}
    for n in sorted(lengths):
        for m in SHORT.get(n, ()):
            need.setdefault(m, []).append(n)
    return need


def seeds(df: DataFrame, id_col: str, short: dict, items: bool = False) -> DataFrame:
    """(id, pos, seed) of every masked window of ``tokens``; ``items`` are read
    through the ``short`` masks of their own length only."""
    masks = [*MASKS, *short]
    span = 1 + max(m[-1] for m in masks)
    h = df.select(id_col, F.transform("tokens", lambda t: F.xxhash64(t)).alias("h"))
    # one-row Generate: the hashes are made once, not once for each shifted slice
    h = h.select(id_col, F.inline(F.array(F.struct("h")))).where(F.size("h") > min(m[-1] for m in masks))
    shifted = [F.col("h")] + [F.slice("h", k + 1, F.greatest(F.size("h") - k, F.lit(0))) for k in range(1, span)]
    at = h.select(id_col, F.size("h").alias("n"),
                  F.posexplode(F.arrays_zip(*[a.alias(f"h{k}") for k, a in enumerate(shifted)])).alias("pos", "z"))
    made = []
    for i, m in enumerate(masks):
        fits = F.col(f"z.h{m[-1]}").isNotNull()
        if items and m in short:
            fits &= F.col("n").isin(short[m])
        made.append(F.when(fits, F.xxhash64(F.lit(i), *[F.col(f"z.h{k}") for k in m])))
    return at.select(id_col, "pos", F.explode(F.array(*made)).alias("seed")).where("seed IS NOT NULL")


def contaminated(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, item_id, position, n_tokens, n_agree): every text and item that
    overlap, with the best diagonal's item start in the text (negative if the
    text has its tail only), its overlap and agreeing tokens."""
    texts = id_text(docs).where("doc_id IS NOT NULL")
    items = (id_text(benchmark, "item_id").withColumnRenamed("doc_id", "item_id").where("item_id IS NOT NULL")
             .distinct().select("item_id", tokens("text").alias("tokens")).where(F.size("tokens") >= p.shortest))
    items = keep(items, "benchmark-items")
    lengths = items.select(F.size("tokens").alias("n")).where(F.col("n").isin(list(SHORT))).distinct().collect()
    short = short_masks(r.n for r in lengths)
    wanted = seeds(items, "item_id", short, items=True).withColumnRenamed("pos", "item_pos")
    if wanted.count() <= p.broadcast_seeds:
        wanted = F.broadcast(wanted)
    hits = (seeds(texts.select("doc_id", tokens("text").alias("tokens")), "doc_id", short).join(wanted, "seed")
            .select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("position")).distinct())
    hits = keep(hits, "benchmark-hits")
    some = texts.join(hits.select("doc_id").distinct(), "doc_id", "left_semi").distinct()
    some = some.select("doc_id", tokens("text").alias("tokens"))
    # only the tokens of the diagonal travel on to the item
    near = (hits.join(items.select("item_id", F.size("tokens").alias("n")), "item_id").join(some, "doc_id")
            .withColumn("skip", F.greatest(-F.col("position"), F.lit(0)))
            .withColumn("n_tokens", F.least(F.col("n"), F.size("tokens") - F.col("position")) - F.col("skip"))
            .select("doc_id", "item_id", "position", "skip", "n_tokens",
                    F.slice("tokens", F.col("position") + F.col("skip") + 1, F.col("n_tokens")).alias("own")))
    same = (near.join(items, "item_id")
            .select("doc_id", "item_id", "position", "n_tokens", (F.col("n_tokens") == F.size("tokens")).alias("whole"),
                    F.zip_with("own", F.slice("tokens", F.col("skip") + 1, F.col("n_tokens")),
                               lambda a, b: (a == b).cast("int")).alias("same")))
    same = same.select("doc_id", "item_id", "position", "n_tokens", "whole", F.inline(F.array(F.struct("same"))))
    size = F.least(F.lit(p.window), F.col("n_tokens"))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("n_tokens") - size + 1), lambda i: F.aggregate(
        F.slice("same", i, size), F.lit(0), lambda s, x: s + x)))
    enough = F.when(F.col("n_tokens") >= p.window, F.lit(p.agree)).when(
        F.col("whole"), F.ceil(F.col("n_tokens") * F.lit(p.agree) / F.lit(p.window)))
    n_agree = F.aggregate("same", F.lit(0), lambda s, x: s + x)
    return (same.where(best >= enough)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct(
                n_agree.alias("n_agree"), (-F.col("position")).alias("early"), "n_tokens")).alias("b"))
            .select("doc_id", "item_id", (-F.col("b.early")).cast("long").alias("position"),
                    F.col("b.n_tokens").cast("long").alias("n_tokens"), F.col("b.n_agree").cast("long").alias("n_agree")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` without the texts that overlap a benchmark item."""
    leaks = contaminated(docs, benchmark, p).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(leaks, docs["doc_id"].cast("long") == leaks["leak_id"], "left_anti")


def _seed_sql(table: str, key: str, items: bool = False) -> str:
    short = short_masks(SHORT)
    made = []
    for n, m in enumerate([*MASKS, *short]):
        own = f" WHERE len(t) IN ({', '.join(map(str, short[m]))})" if items and m in short else ""
        made.append(f"SELECT {key}, i - 1 AS pos, '{n}' || {' || chr(31) || '.join(f't[i + {k}]' for k in m)} AS seed "
                    f"FROM {table}, range(1, len(t) - {m[-1]} + 1) r(i){own}")
    return f"({' UNION ALL '.join(made)})"


_P = Params()
#: The same in DuckDB SQL, for items of any length: masked windows compared as text,
#: all diagonals they name verified.
LEAKS_SQL = f"""
bt AS (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t
       FROM benchmark WHERE item_id IS NOT NULL),
dt AS (SELECT DISTINCT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t
       FROM {{docs}} WHERE doc_id IS NOT NULL),
hit AS (SELECT DISTINCT d.doc_id, b.item_id, d.pos - b.pos AS position
        FROM {_seed_sql('dt', 'doc_id')} d JOIN {_seed_sql('bt', 'item_id', items=True)} b USING (seed)),
al AS (SELECT hit.*, greatest(-position, 0) AS skip, len(bt.t) AS n,
              least(len(bt.t), len(dt.t) - position) - greatest(-position, 0) AS n_tokens, dt.t AS dtok, bt.t AS btok
       FROM hit JOIN dt USING (doc_id) JOIN bt USING (item_id)),
eq AS (SELECT doc_id, item_id, position, n, n_tokens,
              list_transform(range(1, n_tokens + 1), lambda i: (dtok[position + skip + i] = btok[skip + i])::INT) AS same FROM al),
ok AS (SELECT *, list_sum(same)::BIGINT AS n_agree FROM eq WHERE
         list_max(list_transform(range(1, n_tokens - least({_P.window}, n_tokens) + 2),
                  lambda i: list_sum(same[i : i + least({_P.window}, n_tokens) - 1])))
         >= CASE WHEN n_tokens >= {_P.window} THEN {_P.agree} WHEN n_tokens = n THEN ceil(n_tokens * {_P.agree} / {_P.window}) END),
leaks AS (SELECT doc_id, item_id, position::BIGINT AS position, n_tokens::BIGINT AS n_tokens, n_agree
          FROM ok QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_agree DESC, position, n_tokens DESC) = 1)
"""

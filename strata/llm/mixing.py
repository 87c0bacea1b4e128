"""Sources mixed to weights of a temperature: exponents of their token shares, found by bisection.

A source with the share p of all tokens gets a weight in proportion to ``p ** exponent``: 1 leaves the shares, 0 makes
all equal. The exponent is bisected on a grid of ``2**-20`` to the smallest (the flattest mixture) under which no source
is repeated more often than ``repetition_limit``, or to the largest whose entropy reaches ``entropy`` (in bits); with
both, the limit goes first. The budget of tokens is given, or such that the least repeated source is taken just once:
then every document is taken at least once.

A source's budget is realised by whole passes and a part of one more. For that part its documents are permuted by a
hash and cut into blocks along the permutation; sums over blocks say which blocks are in, and only the block in which
the budget ends is looked at row by row, so that no task needs a whole source in order.

Rows: a null source and the empty one are one source. Tokens are words; documents without any cost nothing and are taken
with their block. Sources without tokens are taken once. Null doc_ids and repeated rows are rows like any other. An empty
table gives no rows. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from strata.session import written

STEPS = 20
BLOCK_ROWS = 4096
SEED = 17

SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as n_tokens
  from documents
), s as (
  select source, sum(n_tokens)::bigint as tokens, count(*) as docs from d group by source
), e as (
  select min(k) / 1048576.0::double as exponent
  from range(0, 1048577) as g(k), (select max(tokens)::double / min(tokens) as ratio from s where tokens > 0)
  where pow(ratio, 1 - k / 1048576.0::double) <= 2.0::double + 1e-12::double
), b as (
  select source, tokens, exponent, greatest((docs + 4095) // 4096, 1) as blocks,
         pow(tokens::double / (select sum(tokens) from s)::double, exponent)
           / (select sum(pow(tokens::double / (select sum(tokens) from s)::double, exponent)) from s, e where tokens > 0) as weight,
         case when tokens > 0
              then round(tokens * pow((select max(tokens) from s)::double / tokens, 1 - exponent))::bigint else 0 end as budget
  from s, e
), k as (
  select d.*, exponent, case when tokens > 0 then round(weight, 6) else 0.0::double end as weight, budget,
         case when tokens > 0 then budget // tokens else 1 end as whole,
         case when tokens > 0 then budget % tokens else 0 end as part,
         md5('17:' || case when tokens > 0 then budget // tokens else 1 end || ':' || coalesce(doc_id::varchar, '')) as key
  from d join b using (source)
), c as (
  select *, sum(n_tokens) over (partition by source order by key, doc_id rows unbounded preceding) as upto from k
)
select doc_id, source, n_tokens, exponent, weight, budget as budget_tokens,
       (whole + case when part > 0 and upto <= part then 1 else 0 end)::bigint as copies
from c
"""


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source() -> Column:
    return F.coalesce("source", F.lit(""))


def _bisect(low_ok) -> float:
    """The smallest point of the grid for which ``low_ok`` holds; it holds from there on."""
    low, high = 0, 1 << STEPS
    while low < high:
        middle = (low + high) // 2
        if low_ok(middle / (1 << STEPS)):
            high = middle
        else:
            low = middle + 1
    return low / (1 << STEPS)


def exponent(sources: DataFrame, repetition_limit: float | None, entropy: float | None, budget: int | None) -> float:
    """The exponent for a table of sources with their tokens (> 0). Each step is one small aggregation."""
    total, largest = sources.agg(F.sum("tokens"), F.max("tokens")).first()
    if not total:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))

    def repeats(a: float) -> bool:
        if budget is None:
            most = F.max(F.pow(F.lit(float(largest)) / F.col("tokens"), F.lit(1 - a)))
        else:
            most = F.max(F.pow(share, F.lit(a)) / F.col("tokens")) * F.lit(float(budget)) / F.sum(F.pow(share, F.lit(a)))
        return sources.agg(most).first()[0] <= repetition_limit + 1e-12

    def below(a: float) -> bool:
        """Whether the entropy of the weights lies below the target."""
        power = F.pow(share, F.lit(a))
        z, weighted = sources.agg(F.sum(power), F.sum(power * F.log2(power))).first()
        return math.log2(z) - weighted / z < entropy

    found = []
    if repetition_limit is not None:
        found.append(_bisect(repeats))
    if entropy is not None:
        found.append(max(_bisect(below) - 1 / (1 << STEPS), 0.0) if below(1.0) else 1.0)
    return max(found) if found else 1.0


def budgets(rows: DataFrame, repetition_limit: float | None, entropy: float | None, budget: int | None) -> DataFrame:
    """For each source of ``rows`` (source, n_tokens): weight, budget, whole passes, tokens of the part, blocks."""
    sources = written(
        rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "mix-sources"
    )
    with_tokens = sources.filter("tokens > 0")
    a = exponent(with_tokens, repetition_limit, entropy, budget)
    total, largest = with_tokens.agg(F.sum("tokens"), F.max("tokens")).first()
    total, largest = float(total or 1), float(largest or 1)
    power = F.pow(F.col("tokens") / F.lit(total), F.lit(a))
    z = with_tokens.agg(F.sum(power)).first()[0] or 1.0
    if budget is None:
        own = F.col("tokens") * F.pow(F.lit(largest) / F.col("tokens"), F.lit(1 - a))
    else:
        own = power / F.lit(z) * F.lit(float(budget))
    some = F.col("tokens") > 0
    table = sources.select(
        "source",
        F.lit(a).alias("exponent"),
        F.when(some, F.round(power / F.lit(z), 6)).otherwise(F.lit(0.0)).alias("weight"),
        F.when(some, F.round(own).cast("long")).otherwise(F.lit(0).cast("long")).alias("budget_tokens"),
        "tokens",
        F.greatest(F.ceil(F.col("docs") / BLOCK_ROWS), F.lit(1)).cast("long").alias("blocks"),
    )
    whole = F.when(some, F.expr("budget_tokens div tokens")).otherwise(F.lit(1).cast("long"))
    part = F.when(some, F.col("budget_tokens") % F.col("tokens")).otherwise(F.lit(0).cast("long"))
    return written(table.select("*", whole.alias("whole"), part.alias("part")), "mix-budgets")


def _placed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with their source's budget, permutation key and block."""
    own = table.select("source", *(F.col(c).alias(f"__{c}") for c in ("whole", "part", "blocks")))
    key = F.md5(F.concat_ws(":", F.lit(str(SEED)), F.col("__whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    place = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") * F.col("__blocks")
    return rows.join(own, "source").withColumn("__key", key).withColumn("__block", F.shiftright(place, 32))


def _ends(placed: DataFrame) -> DataFrame:
    """For each block the tokens in its source's blocks before it, and whether the part ends within or beyond it."""
    before = W.Window.partitionBy("source").orderBy("__block").rowsBetween(W.Window.unboundedPreceding, -1)
    sums = placed.groupBy("source", "__block", "__part").agg(F.sum("n_tokens").alias("own"))
    running = sums.withColumn("__before", F.coalesce(F.sum("own").over(before), F.lit(0).cast("long")))
    inside = F.when((F.col("__part") > 0) & (F.col("__before") + F.col("own") <= F.col("__part")), F.lit(1))
    edge = F.when((F.col("__part") > 0) & (F.col("__before") < F.col("__part")), F.lit(2)).otherwise(F.lit(0))
    return written(running.select("source", "__block", "__before", inside.otherwise(edge).alias("__state")), "mix-blocks")


def _copies(placed: DataFrame, ends: DataFrame) -> DataFrame:
    """``placed`` with the number of copies that are taken of each row."""
    joined = placed.join(ends, ["source", "__block"])
    order = W.Window.partitionBy("source", "__block").orderBy("__key", "doc_id").rowsBetween(W.Window.unboundedPreceding, 0)
    upto = F.col("__before") + F.sum("n_tokens").over(order)
    plain = joined.filter("__state <> 2").withColumn("copies", F.col("__whole") + F.col("__state"))
    edge = joined.filter("__state = 2").withColumn(
        "copies", F.col("__whole") + F.when(upto <= F.col("__part"), F.lit(1)).otherwise(F.lit(0))
    )
    return plain.union(edge)


def mixture(
    docs: DataFrame, repetition_limit: float | None = 2.0, entropy: float | None = None, budget: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, n_tokens, exponent, weight, budget_tokens, copies."""
    rows = written(docs.select(F.col("doc_id").cast("long"), _source().alias("source"), word_count("text").alias("n_tokens")), "mix-rows")
    table = budgets(rows, repetition_limit, entropy, budget)
    placed = _placed(rows, table)
    taken = _copies(placed, _ends(placed)).select("doc_id", "source", "n_tokens", "copies")
    return taken.join(table.select("source", "exponent", "weight", "budget_tokens"), "source").select(
        "doc_id", "source", "n_tokens", "exponent", "weight", "budget_tokens", F.col("copies").cast("long").alias("copies")
    )


def mixed(
    docs: DataFrame, repetition_limit: float | None = 2.0, entropy: float | None = None, budget: int | None = None
) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with all their columns."""
    inner = [f"__col{k}" for k in range(len(docs.columns))]
    kept = docs.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, inner, strict=True)),
        F.col("doc_id").cast("long").alias("doc_id"),
        _source().alias("source"),
        word_count("text").alias("n_tokens"),
    )
    rows = written(kept.select("doc_id", "source", "n_tokens"), "mix-rows")
    table = budgets(rows, repetition_limit, entropy, budget)
    ends = _ends(_placed(rows, table))
    taken = _copies(_placed(kept, table), ends).withColumn("__copy", F.explode(F.expr("array_repeat(0, int(copies))")))
    return taken.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, inner, strict=True)))

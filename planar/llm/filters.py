"""Filter interaction audit: every order of a set of filters, from mask cells.

Documents are reduced to cells: per part and mask (one bit per filter that a
document fails) the number of documents, good ones and toxic ones.  A
recursive CTE starts from the empty prefix over the masks that occur and
extends each prefix by every unused letter, carrying the bits applied so far;
each level says, per mask, what its step does.  Joined with the cells that
gives the counts of every prefix, and a full order is read off its prefixes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from planar.llm.common import prepare, text_key, utf8, word_chunks

LETTERS = "ABCDE"
CONTINUATION = bytes(range(0x80, 0xC0))
CAPITALS = bytes(range(0x41, 0x5B))
SYMBOLS = b"#$%&*|"
LONG_TEXT = 8 << 20  # longer texts count distinct words by 64-bit hashes


def _word_counts(buf: bytes) -> tuple[int, int]:
    """Words and distinct words."""
    if len(buf) <= LONG_TEXT:
        words = buf.split()
        return len(words), len(set(words))
    n, seen = 0, np.zeros(0, np.uint64)
    for words in word_chunks(buf):
        n += len(words)
        seen = np.union1d(seen, np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    return n, len(seen)


def text_mask(buf: bytes) -> int:
    """Bits of the filters that a text fails by itself: A (bit 0) under 100
    words, B under 80% distinct words, C over 10% capitals, D a symbol."""
    words, distinct = _word_counts(buf)
    points = len(buf.translate(None, CONTINUATION))
    capitals = len(buf) - len(buf.translate(None, CAPITALS))
    fails = (
        words < 100,
        100 * distinct < 80 * words,
        100 * capitals > 10 * points,
        len(buf.translate(None, SYMBOLS)) < len(buf),
    )
    return sum(f << i for i, f in enumerate(fails))


@F.pandas_udf(T.IntegerType())
def text_masks(bufs: pd.Series) -> pd.Series:
    return bufs.map(text_mask)


def mask_cells(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and failed filters
    (bit 4: the text is that of a smaller id).

    A null text is empty, a null part the empty string.  A row without an id
    is no copy and has no copies; rows that repeat an id with the same text
    are no copies of one another.  A document is good (toxic) if any row of
    ``labels`` with its id says 1; labels without an id count for none.
    Other columns are ignored, whatever their names.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text_key(text_col).alias("key"),
        text_masks(F.coalesce(utf8(text_col), F.lit(b""))).alias("own"),
    )
    rows = rows.groupBy("doc_id", "key", "part", "own").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = rows.join(marks, "doc_id", "left").checkpoint()
    # The first id of each text; joined back by text and id, so that a large
    # group of copies is spread by its ids.
    first = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.join(first, ["key", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    n, zero = F.col("n"), F.lit(0)
    return rows.groupBy("part", (F.col("own") + F.when(copy, 16).otherwise(0)).alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(n * F.coalesce("good", zero)).alias("good"), F.sum(n * F.coalesce("toxic", zero)).alias("toxic")
    )


PREFIXES = """
with recursive prefixes(prefix, step, applied, bit, mask) as (
  select '', 0, 0, 0, mask from {masks}
  union all
  select concat(prefix, letter), step + 1, applied | bit, next, mask
  from (select *, cast(shiftleft(1, k) as int) next
        from prefixes lateral view posexplode(split('{letters}', '')) unused as k, letter
        where step < {steps})
  where ((applied | bit) & next) = 0)
select prefix, cast(step as int) step, mask, mask & (applied | bit) = 0 kept,
       mask & bit <> 0 and mask & applied = 0 removed, mask & bit <> 0 and mask & applied <> 0 redundant, mask = bit alone
from prefixes where step > 0
"""


def prefix_steps(masks: DataFrame, letters: str) -> DataFrame:
    """``(prefix, step, mask, kept, removed, redundant, alone)``: what the
    last filter of each prefix does to the documents of each mask (a column
    ``mask``, distinct).  At most one row per prefix and mask, whatever the
    number of documents: 10,400 for five filters."""
    query = PREFIXES.replace("{letters}", letters).replace("{steps}", str(len(letters)))
    return masks.sparkSession.sql(query, masks=masks)


def audit_orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley)`` for each part, order of all filters and
    step, zeros included, from ``mask_cells`` (bit i: the i-th letter).  No
    cells give no rows."""
    cells = cells.checkpoint()
    steps = prefix_steps(cells.select("mask").distinct(), letters).checkpoint()
    n = F.col("n")
    count = lambda what, flag: F.sum(F.when(F.col(flag), F.col(what)).otherwise(0)).cast("long")
    metrics = (
        cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step")
        .agg(
            count("n", "kept").alias("kept"), count("n", "removed").alias("removed"), count("n", "redundant").alias("redundant"),
            count("n", "alone").alias("unique_fails"), count("good", "removed").alias("good_lost"),
            count("toxic", "removed").alias("toxic_lost"),
        )
        .withColumn("letter", F.substring("prefix", -1, 1))
    ).checkpoint()
    # A prefix of k letters begins (all - k)! orders.
    orders = F.element_at(F.array(*[F.lit(math.factorial(len(letters) - k)) for k in range(1, len(letters) + 1)]), F.col("step"))
    shapley = metrics.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).cast("long").alias("shapley"))
    whole = (
        steps.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
        .select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
        .withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    )
    return (
        metrics.join(shapley, ["part", "letter"]).join(F.broadcast(whole), ["prefix", "step"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit_orders`` of the five filters of ``mask_cells``."""
    return audit_orders(mask_cells(docs, labels))


FILTER_AUDIT_SQL = r"""
with recursive d as (select doc_id, coalesce(lang, '') part, coalesce(text, '') t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') ws from d),
f as (select t, min(doc_id) first from d group by t),
lab as (select doc_id, max((quality = 1)::int) good, max((toxic = 1)::int) toxic from labels where doc_id is not null group by doc_id),
m as (select part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
   (len(ws) < 100)::int + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::int
   + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::int
   + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(w.doc_id > f.first, false)::int mask
   from w join f using (t) left join lab on w.doc_id = lab.doc_id),
p as (select '' o, 0 step, 0 applied, 0 b
  union all select o || chr(65 + k::int), step + 1, applied | b, (1 << k::int)::int from p, range(5) r(k) where ((applied | b) & (1 << k::int)::int) = 0),
q as (select part, o, p.step,
   count(*) filter ((mask & (applied | b)) = 0) kept,
   count(*) filter ((mask & b) <> 0 and (mask & applied) = 0) removed,
   count(*) filter ((mask & b) <> 0 and (mask & applied) <> 0) redundant,
   count(*) filter (mask = b) unique_fails,
   count(*) filter (good = 1 and (mask & b) <> 0 and (mask & applied) = 0) good_lost,
   count(*) filter (toxic = 1 and (mask & b) <> 0 and (mask & applied) = 0) toxic_lost
   from p, m where p.step > 0 group by all),
r as (select q.*, full_order.o filter_order from q join (select o from p where step = 5) full_order on q.o = left(full_order.o, q.step)),
s as (select part, right(o, 1) letter, sum(removed)::bigint shapley from r group by all)
select r.part, filter_order, r.step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley
from r join s on r.part = s.part and right(r.o, 1) = s.letter
"""

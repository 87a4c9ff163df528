"""Operator 9: iterative proportional fitting of token weights, in DataFrame functions only.

Token weights are summed over (source, language, topic). Raking scales them until the shares of
every source, language and topic meet their targets: weight = tokens * a[source] * b[language] *
c[topic]. Documents are then kept with a probability proportional to a*b*c, scaled so that the
largest is one; the expected token shares of the sample are the targets.

One round is one aggregation over a table with a row per source: the source factors have a closed
form given b and c, so only the sums per (language, topic) leave the cluster. Languages and topics
are closed label sets; ``MAX_PAIRS`` bounds their product. Sources may be any number.

Targets: a number is the exponent by which observed shares are tempered (1 keeps them, 0 makes
them equal); a dict names shares, and values it does not name get none.

Defined results: null labels form a category of their own; null or empty texts weigh nothing and
take their category's probability; repeated rows share one decision, which depends on the id alone;
an empty table gives no rows; all columns are kept, but for those named like the four that are added
(``drawn`` keeps them as well). Targets that zero cells rule out are met as
nearly as the last round left them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import stored
from lectern.llm.line_dedup import own_columns

ROUNDS, TOLERANCE, MAX_PAIRS = 60, 1e-12, 100_000
#: Exponents of the production mix.
SOURCE, LANG, TOPIC = 0.75, 0.85, 0.9
SEED = "mix"

Target = float | dict[str, float]


def tokens(text: Column) -> Column:
    """Words: runs between single white-space characters; nothing for null and empty texts."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0).otherwise(F.length(text) - F.length(F.translate(text, " \n\t", "")) + 1).cast("long")


def topic(text: Column) -> Column:
    """The kind of writing, as far as its marks tell: the default topic of a text."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("!!"), "shouting")
        .when(text.contains("###") | text.contains("%%%"), "symbols")
        .when(text.contains("icense"), "licensed")
        .otherwise("prose")
    )


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key alone: 52 bits of its MD5."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def shares(weights: dict[str, float], target: Target) -> dict[str, float]:
    """Target shares of the categories that occur, summing to one."""
    total = sum(weights.values()) or 1.0
    raw = {k: float(target.get(k, 0.0)) if isinstance(target, dict) else (w / total) ** target if w > 0 else 0.0 for k, w in weights.items()}
    whole = sum(raw.values()) or 1.0
    return {k: v / whole for k, v in raw.items()}


def calibrate(docs: DataFrame, source: Target = SOURCE, lang: Target = LANG, topics: Target = TOPIC, source_col: str = "s", lang_col: str = "l", topic_col: str = "t", weight_col: str = "w") -> tuple[DataFrame, dict[str, float], dict[str, float], float]:
    """Factors: a table (s, a), dicts of language and topic factors, and the largest product."""
    spark = docs.sparkSession
    cells = docs.groupBy(F.col(source_col).alias("s"), F.col(lang_col).alias("l"), F.col(topic_col).alias("t")).agg(F.sum(weight_col).cast("double").alias("w"))
    by_source = stored(cells.filter("w > 0").groupBy("s").agg(F.collect_list(F.struct("l", "t", "w")).alias("cells"), F.sum("w").alias("w")), "cells")
    pairs = by_source.select(F.explode("cells").alias("c")).groupBy("c.l", "c.t").agg(F.sum("c.w").alias("w")).orderBy("l", "t").limit(MAX_PAIRS + 1).collect()
    if len(pairs) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of language and topic")
    if not pairs:
        return spark.createDataFrame([], "s string, a double"), {}, {}, 1.0
    key = [(r["l"], r["t"]) for r in pairs]
    sums_l: dict[str, float] = {}
    sums_t: dict[str, float] = {}
    for r in pairs:
        sums_l[r["l"]] = sums_l.get(r["l"], 0.0) + r["w"]
        sums_t[r["t"]] = sums_t.get(r["t"], 0.0) + r["w"]
    want_l, want_t = shares(sums_l, lang), shares(sums_t, topics)
    total = sum(sums_l.values())
    if isinstance(source, dict):
        named = F.create_map(*(F.lit(x) for kv in source.items() for x in kv)) if source else F.create_map()
        raw = F.coalesce(named[F.col("s")].cast("double"), F.lit(0.0))
    else:
        raw = F.pow(F.col("w") / F.lit(total), F.lit(float(source)))
    norm = by_source.agg(F.sum(raw)).first()[0] or 1.0
    rows = by_source.select("s", "cells", (raw / F.lit(norm)).alias("want"))
    b, c = dict.fromkeys(want_l, 1.0), dict.fromkeys(want_t, 1.0)

    def factor(values: dict[str, float], name: Column) -> Column:
        return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[name]

    def with_a(b: dict[str, float], c: dict[str, float]) -> DataFrame:
        bound = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + x["w"] * factor(b, x["l"]) * factor(c, x["t"]))
        return rows.select("s", "cells", F.when(bound > 0, F.col("want") / bound).otherwise(0.0).alias("a"))

    for _ in range(ROUNDS):
        got = with_a(b, c).select("a", F.explode("cells").alias("x")).groupBy("x.l", "x.t").agg(F.sum(F.col("a") * F.col("x.w")).alias("w")).collect()
        mass = {(r["l"], r["t"]): r["w"] for r in got}
        before = (b, c)
        b = {x: want_l[x] / m if (m := sum(mass.get((x, t), 0.0) * c[t] for t in c)) > 0 else 0.0 for x in b}
        c = {x: want_t[x] / m if (m := sum(mass.get((v, x), 0.0) * b[v] for v in b)) > 0 else 0.0 for x in c}
        # factors are only defined up to a constant; fix it, so that convergence shows
        scale = max(b.values()) or 1.0
        b = {x: v / scale for x, v in b.items()}
        c = {x: v * scale for x, v in c.items()}
        if all(abs(new[x] - old[x]) <= TOLERANCE * max(1.0, abs(old[x])) for new, old in zip((b, c), before, strict=True) for x in new):
            break
    final = stored(with_a(b, c), "mix")
    top = final.select("a", F.explode("cells").alias("x")).agg(F.max(F.col("a") * factor(b, F.col("x.l")) * factor(c, F.col("x.t")))).first()[0]
    return final.select("s", "a"), b, c, float(top or 1.0)


def drawn(docs: DataFrame, source: Target = SOURCE, lang: Target = LANG, topics: Target = TOPIC, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_of=topic, seed: str = SEED) -> DataFrame:
    """(row, topic, n_tokens, probability, sampled): each row of ``docs`` as it is, and the decision."""
    label = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    work = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        label(source_col).alias("s"),
        label(lang_col).alias("l"),
        F.coalesce(topic_of(docs[text_col]), F.lit("")).alias("t"),
        tokens(docs[text_col]).alias("w"),
        draw(docs[id_col], seed).alias("u"),
    )
    a, b, c, top = calibrate(work.select("s", "l", "t", "w"), source, lang, topics)
    look = lambda values, name: F.coalesce(F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[F.col(name)], F.lit(0.0)) if values else F.lit(0.0)
    odds = F.coalesce(F.col("a"), F.lit(0.0)) * look(b, "l") * look(c, "t") / F.lit(top)
    work = work.join(a, "s", "left").withColumn("p", F.least(odds, F.lit(1.0)))
    return work.select("row", F.col("t").alias("topic"), F.col("w").alias("n_tokens"), F.round("p", 6).alias("probability"), (F.col("u") < F.col("p")).alias("sampled"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the columns topic, n_tokens, probability and sampled; the options are those of ``drawn``."""
    added = ("topic", "n_tokens", "probability", "sampled")
    return drawn(docs, **options).select(*own_columns(docs.columns, added), *added)


def oracle(table: str = "documents", rounds: int = 25) -> str:
    """The same fit with unrolled rounds of plain raking."""
    out = f"""
WITH d AS (SELECT *, coalesce(source, '') AS s, coalesce(lang, '') AS l,
           CASE WHEN text LIKE '% | %' THEN 'table' WHEN text LIKE '%!!%' THEN 'shouting' WHEN contains(text, '###') OR contains(text, '%%%') THEN 'symbols'
                WHEN text LIKE '%icense%' THEN 'licensed' ELSE 'prose' END AS t,
           CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE length(text) - length(translate(text, ' ' || chr(10) || chr(9), '')) + 1 END::BIGINT AS w,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM {table}),
     c0 AS MATERIALIZED (SELECT s, l, t, sum(w)::DOUBLE AS w, sum(w)::DOUBLE AS f FROM d GROUP BY ALL HAVING sum(w) > 0)"""
    for name, exponent in (("s", SOURCE), ("l", LANG), ("t", TOPIC)):
        out += f""",
     g{name} AS MATERIALIZED (SELECT {name}, pow(w, {exponent}) / sum(pow(w, {exponent})) OVER () AS want FROM (SELECT {name}, sum(w) AS w FROM c0 GROUP BY {name}))"""
    step = 0
    for _ in range(rounds):
        for name in "slt":
            out += f""",
     c{step + 1} AS MATERIALIZED (SELECT c.s, c.l, c.t, c.w, c.f * g.want / sum(c.f) OVER (PARTITION BY c.{name}) AS f FROM c{step} c JOIN g{name} g ON c.{name} = g.{name})"""
            step += 1
    return out + f""",
     p AS MATERIALIZED (SELECT s, l, t, f / w / max(f / w) OVER () AS p FROM c{step})
SELECT doc_id, d.t AS topic, d.w AS n_tokens, round(coalesce(p.p, 0), 6) AS probability, u < coalesce(p.p, 0) AS sampled
FROM d LEFT JOIN p ON d.s = p.s AND d.l = p.l AND d.t = p.t"""

"""Evaluation queries over whole eval_results."""

from pyspark.sql import functions as F

from corpusforge.catalog import query
from corpusforge.functions import text as T
from corpusforge.operators import evaluation as E
from corpusforge.plans.sqltext import PAIRS, SCORED
from corpusforge.runtime import spread, table


def _pairs(spark, d):
    return E.pairs(spread(table(spark, d, "eval_results")))


def _scored(spark, d, *metrics):
    return E.scored(_pairs(spark, d), metrics or ("ned", "cer"))


def _round(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("F2 F16 P9", f"with {SCORED} select result_id, round(ned, 6) as ned from s")
def pair_ned(spark, d):
    return _round(_scored(spark, d, "ned").select("result_id", "ned"), "ned")


@query("F3 P9", f"with {SCORED} select result_id, round(cer, 6) as cer from s")
def pair_cer(spark, d):
    return _round(_scored(spark, d, "cer").select("result_id", "cer"), "cer")


@query("F4 F6")
def pair_wer(spark, d):
    return _round(_scored(spark, d, "wer").select("result_id", "wer"), "wer")


@query("P9", f"with {PAIRS} select result_id, source, image, length(pred)::bigint as pred_chars, length(ref)::bigint as ref_chars, md5(ref) as ref_md5 from p")
def label_fallback(spark, d):
    return _pairs(spark, d).select("result_id", "source", "image", F.length("pred").cast("bigint").alias("pred_chars"), F.length("ref").cast("bigint").alias("ref_chars"), F.md5("ref").alias("ref_md5"))


@query("A5 A1 F2 F3 L12", f"""with {SCORED} select source, count(*) as n, round(avg(ned), 6) as ned, round(avg(cer), 6) as cer, round(avg(exact), 6) as exact_match from s group by source""")
def eval_by_source(spark, d):
    return _round(E.by_source(_scored(spark, d)), "ned", "cer", "exact_match")


@query("A1 L12", f"""with {SCORED} select run_name, count(*) as n, round(avg(ned), 6) as mean, round(stddev_pop(ned), 6) as std, round(avg(exact), 6) as exact_match from s group by run_name""")
def eval_summary(spark, d):
    return _round(E.summary(_scored(spark, d, "ned"), "ned", ["run_name"]), "mean", "std", "exact_match")


@query("A6", f"with {SCORED} select round(coalesce(avg(ned), 0), 6) as mean_ned from s")
def corpus_mean_ned(spark, d):
    return _scored(spark, d, "ned").agg(F.round(F.coalesce(F.avg("ned"), F.lit(0.0)), 6).alias("mean_ned"))


@query("A1", f"with {PAIRS} select source, count(*) as n, sum((pred = ref)::int)::bigint as same from p group by source")
def exact_match_rate(spark, d):
    return _pairs(spark, d).groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("pred") == F.col("ref")).alias("same"))


@query("A2", f"""with {SCORED} select run_name, {', '.join(f'round(quantile_cont(cer, {p / 100}), 6) as p{p}' for p in E.PERCENTILES)} from s group by run_name""")
def eval_percentiles(spark, d):
    return _round(E.percentiles(_scored(spark, d, "cer"), "cer", ["run_name"]), *[f"p{p}" for p in E.PERCENTILES])


def _bucket_sql(metric):
    e = E.EDGES[metric]
    rows = ", ".join(f"({a}::double, {'null' if b == E.INF else f'{b}::double'})" for a, b in zip(e[:-1], e[1:]))
    return f"""with {SCORED}, b(lo, hi) as (values {rows}) select b.lo, b.hi, count(s.result_id) as n from b left join s on s.{metric} >= b.lo and (b.hi is null or s.{metric} < b.hi) group by b.lo, b.hi"""


@query("A4", _bucket_sql("ned"))
def ned_buckets(spark, d):
    return E.buckets(_scored(spark, d, "ned"), "ned")


@query("A4", _bucket_sql("cer"))
def cer_buckets(spark, d):
    return E.buckets(_scored(spark, d, "cer"), "cer")


@query("A4 F4")
def wer_buckets(spark, d):
    return E.buckets(_scored(spark, d, "wer"), "wer")


@query("A19", f"""with {SCORED} select case when grouping(run_name) = 1 then 'COMBINED' else run_name end as run_name, count(*) as n, round(avg(ned), 6) as mean, round(quantile_cont(ned, 0.9), 6) as p90 from s group by rollup(run_name)""")
def eval_rollup_combined(spark, d):
    return _round(E.with_combined(_scored(spark, d, "ned"), "run_name", "ned"), "mean", "p90")


@query("O3 W12 F21", f"""with {SCORED}, r as (select result_id, ned, replace(substr(pred, 1, 80), chr(10), '\\n') as pred, replace(substr(ref, 1, 80), chr(10), '\\n') as ref from s order by ned desc, result_id limit 20)
    select result_id, round(ned, 6) as ned, pred, ref from r""")
def worst_n(spark, d):
    return _round(E.worst(_scored(spark, d, "ned"), 20, "result_id"), "ned")


@query("K13 F29 W13", f"""with {SCORED}, b as (select least(floor(ned * 10), 9)::bigint as tenth, count(*) as n from s group by 1)
    select tenth, n, round(100.0 * n / sum(n) over (), 6) as percent from b""")
def ned_histogram(spark, d):
    from pyspark.sql.window import Window

    b = _scored(spark, d, "ned").groupBy(F.least(F.floor(F.col("ned") * 10), F.lit(9)).alias("tenth")).agg(F.count("*").alias("n"))
    return b.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


@query("K13 F29", f"""with {PAIRS}, g as (select source, count(*) as n from p group by source), k as (select source, n, round_even(20.0 * n / (select count(*) from eval_results), 0)::int as k from g)
    select source, n, repeat('█', k) || repeat('░', 20 - k) as bar from k""")
def report_bars(spark, d):
    total = table(spark, d, "eval_results").count()
    return eval_by_source(spark, d).select("source", "n", T.bar(F.col("n"), F.lit(total)).alias("bar"))

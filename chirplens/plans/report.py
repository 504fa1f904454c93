"""The report: three ranked tables over the posts of the last days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplens.config import ReportConfig
from chirplens.functions.times import ntz, parse_as_of
from chirplens.operators import urls, words
from chirplens.operators.filters import filter_as_of, filter_recent, global_count
from chirplens.operators.top_pairs import top_pairs_of_lists, top_pairs_per_run, word_lists
from chirplens.operators.windows import as_one_run
from chirplens.sources.tables import commit_results
from chirplens.streaming.ingest import read_store


def word_counts_report(posts: DataFrame, cfg: ReportConfig) -> DataFrame:
    recent = filter_as_of(posts, cfg.as_of, cfg.days)
    return _word_table(words.word_doc_freq(recent), global_count(recent), cfg)


def urls_report(posts: DataFrame, cfg: ReportConfig) -> DataFrame:
    recent = filter_as_of(posts, cfg.as_of, cfg.days)
    top = urls.top_urls(urls.url_counts(recent), cfg.top_urls)
    return top.select("url", "count", ntz(cfg.as_of).alias("ts"))


def word_cooccur_report(posts: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Runs the pair search at once; what is returned is its small result."""
    recent = filter_as_of(posts, cfg.as_of, cfg.days)
    return _pair_table(top_pairs_per_run(as_one_run(recent), cfg.top_pairs), cfg)


def build_report(posts: DataFrame, cfg: ReportConfig) -> dict[str, DataFrame]:
    return {
        "word_counts": word_counts_report(posts, cfg),
        "urls": urls_report(posts, cfg),
        "word_cooccur": word_cooccur_report(posts, cfg),
    }


def run_report(posts: DataFrame, cfg: ReportConfig, target: str) -> None:
    """Builds the three tables and puts them under ``target``, visible all at once; a run done
    again replaces itself.

    The same tables as ``build_report``; texts are read and cut into words once for both word
    tables.
    """
    recent = filter_as_of(posts, cfg.as_of, cfg.days)
    lists = word_lists(as_one_run(recent)).persist()
    try:
        counts = lists.select("copies", F.explode("words").alias("word")).groupBy("word")
        tables = {
            "word_counts": _word_table(
                counts.agg(F.sum("copies").alias("count")),
                lists.agg(F.sum("copies").alias("n")),
                cfg,
            ),
            "urls": urls_report(posts, cfg),
            "word_cooccur": _pair_table(top_pairs_of_lists(lists, cfg.top_pairs), cfg),
        }
        commit_results(tables, [cfg.as_of], target)
    finally:
        lists.unpersist()


def report_from_store(
    spark: SparkSession, store: str, base: str | None, timestamp: str, target: str
) -> None:
    """The report at a time given as text, over what the ingest has stored."""
    cfg = ReportConfig(as_of=parse_as_of(timestamp))
    posts = filter_recent(read_store(spark, store, base), cfg.as_of, cfg.days)
    run_report(posts, cfg, target)


def _word_table(doc_freq: DataFrame, total: DataFrame, cfg: ReportConfig) -> DataFrame:
    top = words.top_words(doc_freq, total, cfg.top_words)
    return top.select("word", "percent", ntz(cfg.as_of).alias("ts"))


def _pair_table(ranked: DataFrame, cfg: ReportConfig) -> DataFrame:
    return ranked.orderBy("rank").select(
        "w1", "w2", "count", "log_weight", ntz(cfg.as_of).alias("ts")
    )

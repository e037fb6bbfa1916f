"""Reports over quiz answers (the answer wide table, or any table with the columns used).

Each takes an optional day. Without one, all days are reported, each on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutorlake.functions.coding import failed, passed, score_band
from tutorlake.functions.numbers import share
from tutorlake.operators.lists import text_lists
from tutorlake.sources.tables import on_day

PAPER_KEY = ["paperviewid", "paperviewname", "dt", "dn"]
# Columns of the best and worst lists.
RANKED_COLUMNS = [
    "userid", "paperviewid", "paperviewname", "chaptername", "pointname", "sitecoursename", "coursename",
    "majorname", "shortname", "papername", "score", "rk", "dt", "dn",
]


def paper_averages(answers: DataFrame, day: str | None = None, ordered: bool = False) -> DataFrame:
    """Average score and time per paper."""
    averages = on_day(answers, day).groupBy(*PAPER_KEY).agg(
        F.avg("score").cast("decimal(4,1)").alias("avgscore"),
        F.avg("spendtime").cast("decimal(10,1)").alias("avgspendtime"),
    )
    return averages.orderBy(F.desc("avgscore"), "avgspendtime") if ordered else averages


def paper_extremes(answers: DataFrame, day: str | None = None) -> DataFrame:
    """Highest and lowest score per paper."""
    return on_day(answers, day).groupBy(*PAPER_KEY).agg(
        F.max("score").alias("maxscore"), F.min("score").alias("minscore")
    )


def _ranked(answers: DataFrame, places: int, best: bool) -> DataFrame:
    """Answers whose score is among the first ``places`` distinct scores of their paper.

    A missing score is the lowest of all: it comes first among the worst and last among the best.

    Ranking is done on the distinct scores, which a partial aggregation makes few, and the chosen
    scores are joined back. Equal scores can be any number of rows (a third of the table, say), and
    this way they never meet in one task. The chosen scores are at most ``places`` rows per paper, so
    the join is a broadcast below the size threshold and a skew-split shuffle join beyond it.
    """
    order = F.desc_nulls_last("score") if best else F.asc_nulls_first("score")
    ranking = Window.partitionBy("paperviewid", "dt").orderBy(order)
    scores = answers.select("paperviewid", "dt", "score").distinct()
    chosen = scores.withColumn("rk", F.row_number().over(ranking)).where(F.col("rk") <= places)
    key = ["paperviewid", "dt", "score"]
    named = chosen.select(*[F.col(c).alias(f"of_{c}") for c in key], "rk")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in key]
    return answers.join(named, same).select(*RANKED_COLUMNS)


def best_answers(answers: DataFrame, day: str | None = None, places: int = 3) -> DataFrame:
    """Answers with the three highest scores of each paper, ties included."""
    return _ranked(on_day(answers, day), places, best=True)


def worst_answers(answers: DataFrame, day: str | None = None, places: int = 3) -> DataFrame:
    """Answers with the three lowest scores of each paper, ties included."""
    return _ranked(on_day(answers, day), places, best=False)


BAND_KEY = ["paperviewid", "paperviewname", "score_segment", "dt", "dn"]


def band_user_counts(answers: DataFrame, day: str | None = None) -> DataFrame:
    """Answers per paper, score band and user, in ``copies``: the form to store, whatever a band's size."""
    banded = on_day(answers, day).withColumn("score_segment", score_band(F.col("score")))
    return banded.groupBy(*BAND_KEY, "userid").agg(F.count(F.lit(1)).alias("copies"))


def band_users(
    answers: DataFrame, day: str | None = None, parts: int = 1, ordered: bool = False, dealt: bool = False
) -> DataFrame:
    """User ids per paper and score band as comma-separated text, one id per answer, in ``parts`` parts.

    ``dealt``, the answers of one user go round the parts too; see :func:`tutorlake.operators.lists.text_lists`.
    """
    lists = text_lists(band_user_counts(answers, day), BAND_KEY, "userid", "userids", parts, dealt)
    return lists.orderBy("paperviewid", "score_segment", "part") if ordered else lists


def pass_rates(answers: DataFrame, day: str | None = None, keep_all: bool = False) -> DataFrame:
    """Passes, failures and pass rate per paper, in one pass.

    Papers that nobody passed, or nobody failed, are left out unless ``keep_all``.
    """
    counted = on_day(answers, day).groupBy(*PAPER_KEY).agg(
        F.count_if(passed(F.col("score"))).alias("passcount"),
        F.count_if(failed(F.col("score"))).alias("unpasscount"),
    )
    kept = counted if keep_all else counted.where((F.col("passcount") > 0) & (F.col("unpasscount") > 0))
    return kept.withColumn("rate", share(F.col("passcount"), F.col("unpasscount")))


def error_rates(
    answers: DataFrame, day: str | None = None, keep_all: bool = False, ordered: bool = False
) -> DataFrame:
    """Wrong and right answers and error rate per question, in one pass.

    Questions always answered right, or always wrong, are left out unless ``keep_all``.
    """
    flag = F.col("user_question_answer").cast("string")
    counted = on_day(answers, day).groupBy("questionid", "dt", "dn").agg(
        F.count_if(flag == "0").alias("errcount"), F.count_if(flag == "1").alias("rightcount")
    )
    kept = counted if keep_all else counted.where((F.col("errcount") > 0) & (F.col("rightcount") > 0))
    rated = kept.withColumn("rate", share(F.col("errcount"), F.col("rightcount")))
    return rated.orderBy(F.desc("errcount")) if ordered else rated

"""The registered queries: every operator of the library over whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.raw_logs import ORIGINS, good_line
from checks.shapes import SHAPES
from tutorlake.functions.days import day_of, day_to_date_text, time_text
from tutorlake.functions.numbers import ipv4_number, money, tenth, whole_units
from tutorlake.functions.privacy import mask_name, mask_phone, redacted_password
from tutorlake.operators import learners, member_reports, members, pages, paper_reports, quiz_wide, watching
from tutorlake.operators.zipper import zipper_merge
from tutorlake.plans.member_history import add_days, read_history
from tutorlake.plans.member_sums import update_sums
from tutorlake.session import fresh_dir, reusing_session, stream_session
from tutorlake.sources import streams
from tutorlake.sources.lines import json_objects
from tutorlake.sources.logs import LOGS, clean
from tutorlake.sources.tables import drop_folder, read_table, read_version, settle, write_load
from tutorlake.sources.views import VIEWS, view
from tutorlake.streaming import jobs
from tutorlake.streaming.sinks import current

Query = Callable[[SparkSession, str], DataFrame]
ZIPPER_SPLIT_DAY = "19970101"


# Schemas of stored tables, inferred once: a query reads some tables many times.
SCHEMAS: dict[str, T.StructType] = {}
FACT_KEYS = {"lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}


# Stored bytes of a task of a spread table: some hundred thousand rows of the given facts.
PIECE = 8 * 1024 * 1024


def stored_bytes(rows: DataFrame) -> int:
    spark, jvm = rows.sparkSession, rows.sparkSession._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)) for file in rows.inputFiles()]
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in paths)


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a table stored in fewer pieces than there are cores, spread over all cores.

    Tasks get more, not longer, with the table. A table of many files already has a task per piece and is
    returned as it is, without a shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= cores:
        return rows
    return rows.repartition(max(cores, stored_bytes(rows) // PIECE), *keys)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A whole table. The given facts are single files with one row group, so a single task unless spread."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    rows = spark.read.schema(SCHEMAS[path]).parquet(path)
    return spread(rows, *FACT_KEYS[table]) if table in FACT_KEYS else rows


def read_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as a stream of files, spread over the cores like a batch read if it is too few pieces."""
    stored = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    stream = spark.readStream.schema(stored.schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
    cores = spark.sparkContext.defaultParallelism
    return stream if stored.rdd.getNumPartitions() >= cores else stream.repartition(cores, stored.columns[0])


def shape(spark: SparkSession, sf_dir: str, name: str, reader=read) -> DataFrame:
    text = SHAPES[name]
    inputs = {table: reader(spark, sf_dir, table) for table in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **inputs)


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines hand back the same kind of value."""
    return rows.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


# Raw lines -------------------------------------------------------------------------------------


def raw_log(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Spread first: the given tables are single files with one row group, hence a single task."""
    rows = read(spark, sf_dir, ORIGINS[table][0])
    lines = spread(rows, *rows.columns[:4]).select(F.expr(good_line(table)).alias("line"))
    line = F.col("line")
    # The last character is a brace, so a byte.
    short = F.substring(line.cast("binary"), F.lit(1), F.octet_length(line) - 1).cast("string")
    broken = [
        short, F.concat(F.lit("["), line, F.lit("]")), F.concat(line, F.lit(" tail")),
        F.concat(line, line), F.concat(line, F.lit(" x}")), F.replace(line, F.lit('"'), F.lit("'")), F.lit('"text"'), F.lit(""),
    ]
    return lines.select(F.explode(F.array(line, *broken)).alias("value"))


TWO_LOADS = "dwd_pcentermempaymoney"


def two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log cleaned as two loads that share days and sites, the second one twice, and read back."""
    root = fresh_dir(spark, "loads")
    lines = raw_log(spark, sf_dir, TWO_LOADS)
    # Cleaned once: the loads hold the same lines and differ in their sites only.
    rows = settle(clean(lines, TWO_LOADS).withColumn("dt", F.coalesce("dt", F.lit("none"))), "cleaned")
    stored = rows.withColumn("dt", F.right("dt", F.lit(1))).withColumn("dn", F.concat(F.lit("00"), F.col("uid") % 3))
    plain_sites = rows.withColumn("dt", F.right("dt", F.lit(1))).withColumn("dn", (F.col("uid") % 3).cast("string"))
    for load, part in (("first", stored), ("second", plain_sites), ("second", plain_sites)):
        write_load(part, root, TWO_LOADS, load, ["dt", "dn"])
    return read_table(spark, root, TWO_LOADS).groupBy("dt", "dn").agg(
        F.count(F.lit(1)).alias("n"), F.max("uid").alias("uid"), F.count("paymoney").alias("paid")
    )


def tab_lines(rows: DataFrame) -> DataFrame:
    """Each row as a good line, with trailing tabs (still good), with too few fields and too many."""
    text = [F.col(name).cast("string") for name in rows.columns]
    whole = F.concat_ws("\t", *text)
    short = F.concat_ws("\t", *text[:-1])
    variants = [
        whole, F.concat(whole, F.lit("\t\t")), short, F.concat(short, F.lit("\t")), F.concat(whole, F.lit("\tmore")),
    ]
    return rows.select(F.explode(F.array(*variants)).alias("value"))


def json_lines(rows: DataFrame) -> DataFrame:
    """Each row as a JSON line, and cut short."""
    line = F.to_json(F.struct(*rows.columns))
    return rows.select(F.explode(F.array(line, F.left(line, F.length(line) - 1))).alias("value"))


# Warehouse -------------------------------------------------------------------------------------


def clean_query(table: str) -> Query:
    return lambda spark, sf_dir: plain(clean(raw_log(spark, sf_dir, table), table))


def wide(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    def part(name: str) -> DataFrame:
        return view(shape(spark, sf_dir, VIEWS[name].table), name)

    if table == "dws_qz_chapter":
        return quiz_wide.chapter_wide(
            part("qz_chapter"), part("qz_chapter_list"), part("qz_point"), part("qz_point_question")
        )
    if table == "dws_qz_course":
        return quiz_wide.course_wide(part("qz_site_course"), part("qz_course"), part("qz_course_edusubject"))
    if table == "dws_qz_major":
        return quiz_wide.major_wide(part("qz_major"), part("qz_website"), part("qz_business"))
    if table == "dws_qz_paper":
        return quiz_wide.paper_wide(
            part("qz_paper_view"), part("qz_center_paper"), part("qz_center"), part("qz_paper")
        )
    if table == "dws_qz_question":
        return quiz_wide.question_wide(part("qz_question"), part("qz_question_type"))
    if table == "dws_member":
        return members.member_wide(
            part("member"), part("regtype"), part("base_ad"), part("base_website"), part("payment"), part("vip_level")
        )
    return shape(spark, sf_dir, table)


def wide_query(table: str) -> Query:
    return lambda spark, sf_dir: plain(wide(spark, sf_dir, table))


def view_query(name: str) -> Query:
    return lambda spark, sf_dir: plain(view(wide(spark, sf_dir, VIEWS[name].table), name))


ANSWER_WIDE_COLUMNS = [
    "userid", "questionid", "useranswer", "score", "spendtime", "user_question_answer", "sitecourseid", "siteid",
    "courseid", "coursename", "course_creator", "edusubjectid", "chapterid", "chaptername", "chapterlistname",
    "pointid", "pointname", "point_score", "majorid", "majorname", "businessname", "sitename", "paperviewid",
    "paperviewname", "centerid", "centername", "papername", "totalscore", "questypeid", "question_content",
    "question_answer", "question_description", "dt", "dn",
]


def answer_wide(spark: SparkSession, sf_dir: str, repeat: bool = False) -> DataFrame:
    sibling = reusing_session(spark)

    def part(name: str) -> DataFrame:
        return view(wide(sibling, sf_dir, VIEWS[name].table), name)

    rows = quiz_wide.answer_wide(
        part("qz_answer"), part("wide_course"), part("wide_chapter_question"), part("wide_major"),
        part("wide_paper"), part("wide_question"), repeat_chapters=repeat,
    )
    return plain(rows.select(*ANSWER_WIDE_COLUMNS))


def left_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["member", "regtype", "base_ad", "base_website", "payment", "vip_level"]
    return plain(members.left_chain(*[view(shape(spark, sf_dir, VIEWS[n].table), n) for n in names]))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "dwd_pcentermempaymoney")
    return rows.withColumn("paymoney", money(F.col("paymoney")))


def day_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(members.day_payments(payments(spark, sf_dir), shape(spark, sf_dir, "dwd_vip_level")))


def zipper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days before the split become the stored history, to which the days from the split are added."""
    days = members.day_payments(payments(spark, sf_dir), shape(spark, sf_dir, "dwd_vip_level"))
    date = f"{ZIPPER_SPLIT_DAY[:4]}-01-01"
    earlier, later = days.where(F.col("start_time") < date), days.where(F.col("start_time") >= date)
    history = settle(zipper_merge(days.where(F.lit(False)), earlier, "0001-01-01"), "zipper")
    return plain(zipper_merge(history, later, date))


def member_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored history after three runs: the days before the split, those from it on, and these once more."""
    days = members.day_payments(payments(spark, sf_dir), shape(spark, sf_dir, "dwd_vip_level"))
    date = f"{ZIPPER_SPLIT_DAY[:4]}-01-01"
    root = fresh_dir(spark, "history")
    add_days(spark, root, days.where(F.col("start_time") < date), 10101, 19961231)
    for _ in range(2):
        add_days(spark, root, days.where(F.col("start_time") >= date), int(ZIPPER_SPLIT_DAY), 99991231)
    return plain(read_history(spark, root))


def member_wide_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table from sums that were brought up to date twice: a load of the second time replaces one, one is gone."""
    root, table = fresh_dir(spark, "sums"), VIEWS["payment"].table
    rows = shape(spark, sf_dir, table)
    third = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    for load, part in (("0", rows.where(third == 0)), ("1", rows), ("gone", rows)):
        write_load(part, root, table, load, ["dt"])
    update_sums(spark, root)
    write_load(rows.where(third == 1), root, table, "1", ["dt"])
    write_load(rows.where(third == 2), root, table, "2", ["dt"])
    drop_folder(spark, f"{root}/{table}/load=gone")
    names = ["member", "regtype", "base_ad", "base_website", "vip_level"]
    parts = [view(shape(spark, sf_dir, VIEWS[n].table), n) for n in names]
    return plain(members.wide_of_sums(*parts[:4], update_sums(spark, root), parts[4]))


def member_count(report: str) -> Query:
    column = member_reports.COUNT_REPORTS[report]
    return lambda spark, sf_dir: member_reports.count_members(wide(spark, sf_dir, "dws_member"), column)


def member_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_reports.all_counts(wide(spark, sf_dir, "dws_member"))


def member_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(member_reports.top_payers(wide(spark, sf_dir, "dws_member"), ordered=True))


def paper_query(report: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: plain(report(shape(spark, sf_dir, "answers"), **options))


# Scalar functions ------------------------------------------------------------------------------


def mask_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    phone = F.concat(F.lit("138"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey", mask_name(F.col("c_name")).alias("fullname"), mask_phone(phone).alias("phone"),
        mask_phone(F.col("c_mktsegment")).alias("short_phone"), redacted_password().alias("password"),
    )


def code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tutorlake.functions.coding import platform, register_source, score_band

    digit = F.left("o_orderpriority", F.lit(1))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", register_source(digit).alias("regsourcename"), platform(digit).alias("app_name"),
        score_band((F.col("o_totalprice") / 4000).cast("decimal(10,1)")).alias("score_segment"),
    )


def round_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")).cast("string")
    return plain(
        read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", tenth(text, 12).alias("score"))
    )


def day_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = day_of(F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", day.alias("day"), day_to_date_text(day).alias("date_text"),
        time_text(F.col("o_orderdate")).alias("time_text"),
    )


def address_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "page_events")
    return rows.select("ip", ipv4_number(F.col("ip")).alias("address"), ipv4_number(F.col("page_id")).alias("none"))


def elapsed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "watch_events")
    ts, te = F.col("ts"), F.col("te")
    return rows.select(
        "uid", "ps", whole_units(ts, te).alias("seconds"), whole_units(ts, te, 100).alias("tenths")
    )


def clean_tsv_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tab_lines(shape(spark, sf_dir, "register_events"))
    return learners.with_platform(streams.registrations(lines))


def page_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.page_visits(json_lines(shape(spark, sf_dir, "page_events")))


def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = json_lines(read(spark, sf_dir, "events").select("event_id", "event_type", "props"))
    return json_objects(lines, ["event_id", "event_type", "absent"])


# Streaming -------------------------------------------------------------------------------------


def run_job(spark: SparkSession, sf_dir: str, name: str, shape_name: str, to_lines, job, result) -> DataFrame:
    """Run a streaming job over a table's file to its end and return its result table."""
    sibling = stream_session(spark)
    root = fresh_dir(spark, name)
    lines = to_lines(shape(sibling, sf_dir, shape_name, read_stream))
    job(lines, root, f"{root}/checkpoint").awaitTermination()
    return result(spark, root)


def register_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(
        spark, sf_dir, "register_total", "register_events", tab_lines, jobs.count_registrations,
        lambda s, root: read_version(s, root, "register_total"),
    )


def register_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    def job(lines, root, checkpoint):
        return jobs.count_registrations_in_window(
            lines, root, checkpoint, time=learners.event_time(), length="1 day", slide="6 hours"
        )

    def result(s, root):
        rows = current(s, root, "register_window", jobs.WINDOW_KEY)
        # Windows are in UTC, whatever the time zone of the session that reads them.
        utc = F.expr("timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, unix_seconds(window_start))")
        return rows.select(time_text(utc).alias("window_start"), "app_name", "num")

    def with_unreadable(rows: DataFrame) -> DataFrame:
        times = F.array(F.col("createtime"), F.concat(F.lit("at "), "createtime"))
        return tab_lines(rows.withColumn("createtime", F.explode(times)))

    return run_job(spark, sf_dir, "register_sliding", "register_events", with_unreadable, job, result)


def quiz_mastery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(spark, sf_dir, "mastery", "quiz_events", tab_lines, jobs.track_mastery, jobs.mastery_now)


def quiz_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = learners.question_totals(streams.quiz_answers(tab_lines(shape(spark, sf_dir, "quiz_events"))))
    return learners.question_ids(totals, parts=3)


def learn_by_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(
        spark, sf_dir, "learn", "watch_events", json_lines, jobs.sum_learn_time,
        lambda s, root: current(s, root, "learn_detail", jobs.LEARN_KEY),
    )


def register_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both registration counts of one job; totals have no window."""
    def job(lines, root, checkpoint):
        return jobs.track_registrations(lines, root, checkpoint, time=learners.event_time(), length="1 day", slide="6 hours")

    def result(s, root):
        totals, windows = jobs.registrations_now(s, root)
        utc = F.expr("timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, unix_seconds(window_start))")
        timed = windows.select(F.lit("window").alias("counted"), time_text(utc).alias("window_start"), "app_name", "num")
        return totals.select(F.lit("total").alias("counted"), F.lit(None).cast("string"), "app_name", "num").union(timed).toDF(*timed.columns)

    return run_job(spark, sf_dir, "register_topic", "register_events", tab_lines, job, result)


def course_learn_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learning time by five dimensions and watched ranges per video, of one job."""
    def result(s, root):
        coverage, times = jobs.course_learn_now(s, root)
        video = F.concat_ws("_", *watching.VIDEO)
        none = [F.lit(None).cast(k).alias(c) for c, k in (("effecttime", "bigint"), ("completetime", "bigint"), ("play_interval", "string"))]
        return times.select("dimension", "key", "totaltime", *none).union(
            coverage.select(F.lit("video_learn_detail"), video, "totaltime", "effecttime", "completetime", "play_interval")
        )

    return run_job(spark, sf_dir, "course_learn", "watch_events", json_lines, jobs.track_course_learn, result)


def video_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = streams.watch_events(json_lines(shape(spark, sf_dir, "watch_events")))
    return watching.coverage(events)


def video_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = streams.watch_events(json_lines(shape(spark, sf_dir, "watch_events")))
    return watching.range_text(watching.watched_ranges(events))


def video_coverage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(
        spark, sf_dir, "coverage", "watch_events", json_lines, jobs.track_coverage, jobs.coverage_now
    )


def page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(
        spark, sf_dir, "page_hits", "page_events", json_lines, jobs.count_page_hits,
        lambda s, root: read_version(s, root, "page_hits"),
    )


def page_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(
        spark, sf_dir, "page_funnel", "page_events", json_lines, jobs.count_pages,
        lambda s, root: read_version(s, root, "page_jump_rate"),
    )


def page_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page steps, and page counts with funnel rates, of one job; the latter have one page."""
    def result(s, root):
        steps, rates = jobs.pages_now(s, root)
        none = F.lit(None).cast("string")
        pages_only = rates.select(none.alias("last_page_id"), "page_id", none.alias("next_page_id"), "num", "jump_rate")
        return steps.select(*jobs.STEP_KEY, "num", none.alias("jump_rate")).union(pages_only)

    return run_job(spark, sf_dir, "page_topic", "page_events", json_lines, jobs.track_pages, result)


def page_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_steps(streams.page_visits(json_lines(shape(spark, sf_dir, "page_events"))))


def province_job(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ranges = shape(spark, sf_dir, "ip_ranges")
        return run_job(
            spark, sf_dir, table, "page_events", json_lines,
            lambda lines, root, checkpoint: jobs.count_provinces(lines, ranges, root, checkpoint),
            lambda s, root: read_version(s, root, table),
        )

    return query


def province_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = streams.page_visits(json_lines(shape(spark, sf_dir, "page_events")))
    return pages.province_counts(visits, shape(spark, sf_dir, "ip_ranges"))


def province_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by nation: customers as history, suppliers as the batch that is added."""
    history = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("province")).agg(F.count("*").alias("num"))
    batch = read(spark, sf_dir, "supplier").groupBy((F.col("s_nationkey") + 5).alias("province")).agg(F.count("*").alias("num"))
    return pages.add_counts(history, batch)


def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    sibling = stream_session(spark)
    root = fresh_dir(spark, "archive")
    events = read_stream(sibling, sf_dir, "events")
    line = F.concat_ws("\t", F.col("event_id").cast("string"), "event_type", "props", day_of(F.col("ts")))
    day = F.element_at(F.split("value", "\t"), -1)
    jobs.archive(events.select(line.alias("value")), "page_topic", root, f"{root}/checkpoint", day=day).awaitTermination()
    return spark.read.text(f"{root}/archive").select("value", "topic", F.col("day").cast("string").alias("day"))


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    found.update({f"clean_{table.removeprefix('dwd_')}": clean_query(table) for table in LOGS})
    found.update({f"view_{name}": view_query(name) for name in VIEWS})
    found.update(
        clean_json_keys=json_keys,
        clean_two_loads=two_loads,
        clean_tsv_arity=clean_tsv_arity,
        clean_page_visits=page_visits,
        mask_pii=mask_pii,
        code_map=code_map,
        round_scores=round_scores,
        day_texts=day_texts,
        address_numbers=address_numbers,
        elapsed_units=elapsed_units,
        member_wide_left_chain=left_chain,
        member_wide=wide_query("dws_member"),
        member_wide_stored=member_wide_stored,
        member_day_pay=day_payments,
        zipper_merge=zipper,
        member_history=member_history,
        member_count_appregurl=member_count("ads_register_appregurlnum"),
        member_count_sitename=member_count("ads_register_sitenamenum"),
        member_count_regsource=member_count("ads_register_regsourcenamenum"),
        member_count_adname=member_count("ads_register_adnamenum"),
        member_count_level=member_count("ads_register_memberlevelnum"),
        member_count_vip=member_count("ads_register_viplevelnum"),
        member_counts=member_counts,
        member_top3_pay=member_top3,
        quiz_chapter_wide=wide_query("dws_qz_chapter"),
        quiz_course_wide=wide_query("dws_qz_course"),
        quiz_major_wide=wide_query("dws_qz_major"),
        quiz_paper_wide=wide_query("dws_qz_paper"),
        quiz_question_wide=wide_query("dws_qz_question"),
        quiz_answer_wide=answer_wide,
        quiz_answer_wide_repeated=lambda spark, sf_dir: answer_wide(spark, sf_dir, repeat=True),
        paper_avg=paper_query(paper_reports.paper_averages, ordered=True),
        paper_minmax=paper_query(paper_reports.paper_extremes),
        paper_top3=paper_query(paper_reports.best_answers),
        paper_low3=paper_query(paper_reports.worst_answers),
        paper_segments=paper_query(paper_reports.band_users, ordered=True, parts=4),
        paper_segments_dealt=paper_query(paper_reports.band_users, parts=3, dealt=True),
        paper_segment_users=paper_query(paper_reports.band_user_counts),
        paper_pass_rate=paper_query(paper_reports.pass_rates),
        question_error_rate=paper_query(paper_reports.error_rates, ordered=True),
        register_total=register_total,
        register_sliding=register_sliding,
        quiz_mastery=quiz_mastery,
        quiz_history=quiz_history,
        learn_by_dim=learn_by_dim,
        video_coverage=video_coverage,
        video_ranges=video_ranges,
        video_coverage_stream=video_coverage_stream,
        register_topic=register_topic,
        course_learn_topic=course_learn_topic,
        page_hits=page_hits,
        page_steps=page_steps,
        page_funnel=page_funnel,
        page_topic=page_topic,
        province_counts=province_counts,
        province_totals=province_totals,
        province_detail=province_job("tmp_city_num_detail"),
        province_top3=province_job("top_city_num"),
        raw_archive=raw_archive,
    )
    return found

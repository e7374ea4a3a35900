"""Named queries over the driver's tables: name -> (spark, sf_dir) -> DataFrame.

Each entry composes library operators on the tables mapped by
:mod:`tunetrail.sources.driver_tables`; doubles that come out of sums in
engine-dependent order are rounded to 6 decimals so that value hashes are
comparable with the oracle.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tunetrail.functions.dates import DRIVER_WINDOWS as W
from tunetrail.functions.dates import in_range
from tunetrail.operators import daysketches as sk
from tunetrail.operators import daystates as ds
from tunetrail.operators import events as evx
from tunetrail.operators import explore as ex
from tunetrail.operators import features as fx
from tunetrail.operators import label as lb
from tunetrail.operators import metrics as mt
from tunetrail.operators import models as md
from tunetrail.operators import population as pop
from tunetrail.operators import relu_net as rn
from tunetrail.operators import training as tr
from tunetrail.operators.recsys import evaluate as ev_
from tunetrail.operators.recsys import factors as fa
from tunetrail.operators.recsys import interactions as ia
from tunetrail.operators.recsys import itemcf as cf
from tunetrail.operators.recsys import posted as po
from tunetrail.plans import landing, lines
from tunetrail.session import PART_ROWS, cut_lineage, shared_path, store
from tunetrail.sources import driver_tables as src
from tunetrail.sources import logs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed value: on the driver's events every user is active in both windows,
# so activity for the label is purchases (plays) only.
ACTIVITY = ("P",)
HEAVY_SHARE = 0.01
BUCKETS = 16  # of the event table by uid; on a cluster, table size / 200 MB


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.event_log(spark, sf_dir)


# ------------------------------------------------------------ label + training

@query("training_table_fused")
def q_training_fused(spark, sf_dir):
    return round_doubles(tr.training_table(events(spark, sf_dir), W, ACTIVITY))


@query("training_table_chained")
def q_training_chained(spark, sf_dir):
    return round_doubles(tr.training_table_chained(events(spark, sf_dir), W, ACTIVITY))


@query("model_population")
def q_population(spark, sf_dir):
    return lb.model_population(events(spark, sf_dir), W, ACTIVITY)


@query("churn_label")
def q_churn_label(spark, sf_dir):
    return lb.churn_label(events(spark, sf_dir), W, ACTIVITY)


@query("label_balance")
def q_label_balance(spark, sf_dir):
    return lb.label_balance(lb.churn_label(events(spark, sf_dir), W, ACTIVITY))


# ------------------------------------------------------------- exploration

PREVIEW_ORDER = ("date", "uid", "event", "song_id", "device", "play_time", "song_length")
RANGE_START, RANGE_END = "2024-01-01", "2024-01-05"


@query("event_count")
def q_event_count(spark, sf_dir):
    return ex.row_count(events(spark, sf_dir))


@query("distinct_users")
def q_distinct_users(spark, sf_dir):
    return ex.distinct_count(events(spark, sf_dir), "uid")


@query("count_by_event")
def q_count_by_event(spark, sf_dir):
    return ex.count_by(events(spark, sf_dir), "event")


@query("multi_agg_by_event")
def q_multi_agg(spark, sf_dir):
    return round_doubles(ex.multi_agg(events(spark, sf_dir), "event", "uid"))


@query("range_by_date_event")
def q_range_by_date_event(spark, sf_dir):
    ev = events(spark, sf_dir).where(in_range("date", RANGE_START, RANGE_END))
    return ex.count_by(ev, "date", "event").orderBy("date", "event")


@query("daily_count")
def q_daily_count(spark, sf_dir):
    return ex.count_by(events(spark, sf_dir), "date")


@query("null_report")
def q_null_report(spark, sf_dir):
    return ex.null_report(events(spark, sf_dir))


@query("event_info")
def q_event_info(spark, sf_dir):
    return ex.info(events(spark, sf_dir))


@query("describe_plays")
def q_describe(spark, sf_dir):
    return round_doubles(ex.describe(src.play_log(spark, sf_dir)))


@query("summary_stats")
def q_summary_stats(spark, sf_dir):
    return round_doubles(ex.summary_stats(pop.plays_per_user(src.play_log(spark, sf_dir)), "n_plays"))


@query("preview_ordered")
def q_preview(spark, sf_dir):
    return ex.preview(events(spark, sf_dir), PREVIEW_ORDER, 20)


# -------------------------------------------------------------- population

@query("plays_per_user")
def q_plays_per_user(spark, sf_dir):
    return pop.plays_per_user(src.play_log(spark, sf_dir))


@query("plays_percentile")
def q_plays_percentile(spark, sf_dir):
    return round_doubles(pop.plays_percentile(pop.plays_per_user(src.play_log(spark, sf_dir))))


@query("bots_removed")
def q_bots_removed(spark, sf_dir):
    return pop.bots_removed(pop.plays_per_user(src.play_log(spark, sf_dir)))


@query("plays_log_histogram")
def q_histogram(spark, sf_dir):
    return pop.log_histogram(pop.plays_per_user(src.play_log(spark, sf_dir)))


@query("user_hash_sample")
def q_user_sample(spark, sf_dir):
    return pop.sampled_users(src.play_log(spark, sf_dir))


@query("sampled_events")
def q_sampled_events(spark, sf_dir):
    users = pop.sampled_users(src.play_log(spark, sf_dir))
    return pop.sample_by_users(events(spark, sf_dir), users)


# ------------------------------------------------------------------ events

@query("event_log_union")
def q_event_union(spark, sf_dir):
    return evx.unify(src.play_log(spark, sf_dir), src.down_log(spark, sf_dir), src.search_log(spark, sf_dir))


@query("distinct_user_device")
def q_distinct_user_device(spark, sf_dir):
    return fx.distinct_user_device(src.play_log(spark, sf_dir), W)


@query("users_multi_device")
def q_multi_device(spark, sf_dir):
    return fx.users_multi_device(src.play_log(spark, sf_dir), W)


@query("parse_log_lines")
def q_parse_log_lines(spark, sf_dir):
    # the derived lines are written once (as raw logs would be stored), so the
    # parser's predicates are not planned over the line-building expressions
    raw = cut_lineage(lines.play_lines(spark, sf_dir))
    return round_doubles(logs.parse_lines(raw, "play"))


# ---------------------------------------------------------------- features

def feature_window_events(spark, sf_dir):
    return events(spark, sf_dir).where(in_range("date", W.feature_start, W.feature_end))


@query("freq_single_window")
def q_freq_single(spark, sf_dir):
    return fx.frequency_single(feature_window_events(spark, sf_dir), "S", 3, W.snapshot)


@query("freq_all_windows")
def q_freq_all(spark, sf_dir):
    return feature_window_events(spark, sf_dir).groupBy("uid").agg(*fx.frequency_aggs(W))


@query("recency")
def q_recency(spark, sf_dir):
    return feature_window_events(spark, sf_dir).groupBy("uid").agg(*fx.recency_aggs(W))


@query("recency_sorted_array")
def q_recency_sorted(spark, sf_dir):
    out = fx.last_event(events(spark, sf_dir), "P", W)
    return out.select("uid", F.array_join("events", ",").alias("events"), "last_date", "rec_P")


@query("play_time_windows")
def q_play_time(spark, sf_dir):
    plays = feature_window_events(spark, sf_dir).where(F.col("event") == "P")
    return round_doubles(plays.groupBy("uid").agg(*fx.play_time_aggs(W)))


@query("play_ratio_windows")
def q_play_ratio(spark, sf_dir):
    plays = feature_window_events(spark, sf_dir).where(F.col("event") == "P")
    return plays.groupBy("uid").agg(*fx.play_ratio_aggs(W))


@query("device_profile")
def q_device_profile(spark, sf_dir):
    return fx.device_profile(src.play_log(spark, sf_dir), W)


@query("device_profile_fanout")
def q_device_fanout(spark, sf_dir):
    popu = lb.model_population(events(spark, sf_dir), W, ACTIVITY)
    return fx.device_profile_fanout(popu, src.play_log(spark, sf_dir), W)


@query("device_dummies")
def q_device_dummies(spark, sf_dir):
    t = tr.device_dummies(tr.training_table(events(spark, sf_dir), W, ACTIVITY))
    return t.select("uid", "device_type_1", "device_type_2")


@query("train_test_split")
def q_split(spark, sf_dir):
    return tr.train_test_split(lb.churn_label(events(spark, sf_dir), W, ACTIVITY)).select("uid", "split")


# ------------------------------------------------------------- recommender

# Fixed values for the driver's data: events touching a song after
# 2024-01-24 up to 01-30, users with more than 5, songs with more than 2.
REC_AFTER, REC_UNTIL, REC_MIN_USER, REC_MIN_SONG = "2024-01-24", "2024-01-30", 5, 2


def small_interactions(spark, sf_dir):
    return ia.interactions(src.song_touches(spark, sf_dir), F.to_date(F.lit(REC_AFTER)),
                           F.to_date(F.lit(REC_UNTIL)), REC_MIN_USER, REC_MIN_SONG)


@query("interactions")
def q_interactions(spark, sf_dir):
    return small_interactions(spark, sf_dir)


@query("active_users")
def q_active_users(spark, sf_dir):
    w = ia.window_plays(src.song_touches(spark, sf_dir), F.to_date(F.lit(REC_AFTER)), F.to_date(F.lit(REC_UNTIL)))
    return ia.active_users(w, REC_MIN_USER)


@query("popular_songs")
def q_popular_songs(spark, sf_dir):
    w = ia.window_plays(src.song_touches(spark, sf_dir), F.to_date(F.lit(REC_AFTER)), F.to_date(F.lit(REC_UNTIL)))
    by_user = w.join(ia.active_users(w, REC_MIN_USER).select("uid"), "uid", "left_semi")
    return ia.popular_songs(by_user, REC_MIN_SONG)


@query("play_counts")
def q_play_counts(spark, sf_dir):
    return ia.interaction_counts(src.song_touches(spark, sf_dir), F.to_date(F.lit(REC_AFTER)),
                                 F.to_date(F.lit(REC_UNTIL)), REC_MIN_USER, REC_MIN_SONG)


def rated(spark, sf_dir):
    return ia.ratings(src.purchase_counts(spark, sf_dir))


def utility_of(spark, sf_dir):
    """Mean like of each (uid, song_id).  A song's names change no mean, so they are not joined here, and the mean is taken in
    the partitions of the sum before it."""
    return ia.utility(ia.ratings(src.pair_counts(spark, sf_dir)))


def util_table(spark, sf_dir):
    """The utility table, materialised once (reliable checkpoint in the shared folder; of many line items
    compressed Parquet): similarity, size checks, prediction and top-n all read it."""
    if src.table(spark, sf_dir, "lineitem").count() > PART_ROWS:
        return store(utility_of(spark, sf_dir), "utility")[0]
    return cut_lineage(utility_of(spark, sf_dir))


def neighbour_table(util):
    """Top-75 neighbours, materialised: at most items x 75 rows, read by the
    size check, the prediction join and nothing else recomputes them."""
    return cut_lineage(cf.top_neighbours(util))


@query("ratings")
def q_ratings(spark, sf_dir):
    return rated(spark, sf_dir)


@query("song_value_counts")
def q_song_value_counts(spark, sf_dir):
    return ex.value_counts(rated(spark, sf_dir), "song_id")


@query("rating_value_counts")
def q_rating_value_counts(spark, sf_dir):
    return ex.value_counts(rated(spark, sf_dir), "like")


@query("utility_pivot")
def q_utility_pivot(spark, sf_dir):
    wide = ia.utility_pivot(utility_of(spark, sf_dir), [1, 2, 3, 4, 5])
    return wide.select("uid", *[F.col(f"`{i}`").alias(f"song_{i}") for i in range(1, 6)])


@query("utility")
def q_utility(spark, sf_dir):
    return util_table(spark, sf_dir)


@query("utility_extent")
def q_utility_extent(spark, sf_dir):
    """Extent of the rating matrix -- largest ids, distinct users and songs, cells."""
    u = util_table(spark, sf_dir)
    return u.agg(F.max("uid").alias("max_uid"), F.max("song_id").alias("max_song_id"),
                 F.count_distinct("uid").alias("n_users"), F.count_distinct("song_id").alias("n_songs"),
                 F.count(F.lit(1)).alias("n_cells"))


@query("song_names")
def q_song_names(spark, sf_dir):
    return ia.song_names(rated(spark, sf_dir))


@query("item_similarity")
def q_item_similarity(spark, sf_dir):
    u = util_table(spark, sf_dir)
    posted = po.lay_out(u)
    if posted is not None:
        return cf.both_orders(po.gram(spark, posted))
    return cf.item_similarity(u, blocks=cf.similarity_blocks(u))


@query("item_neighbours")
def q_item_neighbours(spark, sf_dir):
    u = util_table(spark, sf_dir)
    posted = po.lay_out(u)
    return cf.top_neighbours(u) if posted is None else po.top_neighbours(spark, posted)


@query("predicted_ratings")
def q_predicted(spark, sf_dir):
    u = util_table(spark, sf_dir)
    posted = po.lay_out(u)
    if posted is not None:
        return po.predict(spark, posted.files, po.stored_neighbours(po.top_neighbours(spark, posted)))
    return cf.predict(u, neighbour_table(u), parts=cf.prediction_parts(u))


def recommendations(spark, sf_dir, u, users=None):
    """The best unrated songs of all users, or of ``users``.  A song has the same name with each of its ratings, so names come from the parts."""
    names = ia.song_names(src.song_names(spark, sf_dir))
    mine = u if users is None else u.join(users, "uid", "left_semi")
    posted = po.lay_out(u)
    if posted is not None:
        files = posted.files if users is None else po.by_user(mine.where("song_id is not null").select("uid", "song_id", F.col("rating").cast("double").alias("rating")), mine.count())
        return po.recommend(spark, files, po.stored_neighbours(po.top_neighbours(spark, posted)), names)
    return cf.recommend(u, neighbour_table(u), names, users=users, parts=cf.prediction_parts(mine))


@query("top_n_songs")
def q_top_n(spark, sf_dir):
    return recommendations(spark, sf_dir, util_table(spark, sf_dir))


@query("top_n_songs_chosen")
def q_top_n_chosen(spark, sf_dir):
    """Recommendations for a table of chosen users only."""
    u = util_table(spark, sf_dir)
    return recommendations(spark, sf_dir, u, u.select("uid").distinct().where(F.col("uid") % 10 == 0))


@query("masked_errors")
def q_masked_errors(spark, sf_dir):
    u = util_table(spark, sf_dir)
    return round_doubles(ev_.masked_errors(ev_.observed_with_item_mean(u)))


@query("user_errors")
def q_user_errors(spark, sf_dir):
    u = util_table(spark, sf_dir)
    return round_doubles(ev_.user_errors(ev_.observed_with_item_mean(u)))


# ----------------------------------------------------------------- metrics

def scored_table(spark, sf_dir):
    """A fixed score per user for the metric operators: (freq_S_last_14 mod 11) / 10 in [0, 1]."""
    t = tr.train_test_split(tr.training_table(events(spark, sf_dir), W, ACTIVITY))
    return t.select("uid", "label", (F.pmod("freq_S_last_14", F.lit(11)) / 10.0).alias("p"), "split")


@query("classification_metrics")
def q_class_metrics(spark, sf_dir):
    return round_doubles(mt.classification_report(scored_table(spark, sf_dir)))


@query("roc_curve")
def q_roc_curve(spark, sf_dir):
    return round_doubles(mt.roc_curve(scored_table(spark, sf_dir)))


@query("roc_auc")
def q_roc_auc(spark, sf_dir):
    return round_doubles(mt.roc_auc(scored_table(spark, sf_dir)))


# ------------------------------------------------------------------ models
# Each query fits its own model; SQL checks the scored rows, not the scores.

def model_data(spark, sf_dir):
    t = tr.train_test_split(tr.training_table(events(spark, sf_dir), W, ACTIVITY))
    return md.prepare(t), md.feature_names(t)


@query("logistic_scores")
def q_logistic(spark, sf_dir):
    data, _ = model_data(spark, sf_dir)
    n_train = data.where(F.col("split") == "train").count()
    return score_rows(md.fit_and_score(md.logistic(n_train), data)[1])


def forest_fit(spark, sf_dir):
    data, names = model_data(spark, sf_dir)
    model, scored = md.fit_and_score(md.forest(), data)
    return model, scored, names


def score_rows(scored: DataFrame) -> DataFrame:
    """What SQL can state of a fitted model's scores: every row of the table, its label and split, a probability."""
    return scored.select("uid", "label", "split", F.col("p").between(0.0, 1.0).alias("is_probability"))


@query("forest_scores")
def q_forest(spark, sf_dir):
    return score_rows(forest_fit(spark, sf_dir)[1])


@query("forest_importances")
def q_forest_importances(spark, sf_dir):
    model, _, names = forest_fit(spark, sf_dir)
    return md.importances(model, names)


@query("gbt_scores")
def q_gbt(spark, sf_dir):
    data, _ = model_data(spark, sf_dir)
    return score_rows(md.fit_and_score(md.gbt(), data)[1])


@query("mlp_scores")
def q_mlp(spark, sf_dir):
    data, names = model_data(spark, sf_dir)
    return score_rows(md.fit_and_score(md.mlp(len(names)), data)[1])


@query("relu_net_scores")
def q_relu_net(spark, sf_dir):
    """The reference's own network: ReLU, Adam, L2 1e-5."""
    data, _ = model_data(spark, sf_dir)
    return score_rows(rn.score(rn.fit(data.where(F.col("split") == "train")), data))


@query("grid_search")
def q_grid_search(spark, sf_dir):
    data, _ = model_data(spark, sf_dir)
    return score_rows(md.grid_search(data)[1])


@query("model_metrics")
def q_model_metrics(spark, sf_dir):
    """The reference's per-model report: AUC, accuracy, precision, recall, F1 for train and test."""
    return round_doubles(mt.classification_report(forest_fit(spark, sf_dir)[1]))


# --------------------------------------------------------- factor models
# The fits (``nmf_error``, ``svd_error``) are rows-only checks.  The steps they
# are made of, and everything computed from factors, are checked in SQL on
# factors drawn from md5 of the id.

DRAWN_RANK = 8


FITTED_RANK, FITTED_ITERATIONS = 20, 10


def drawn_factors(u: DataFrame, signed: bool) -> fa.Factors:
    return fa.Factors(fa.md5_factors(u.select("uid").distinct(), "uid", DRAWN_RANK, "u", signed),
                      fa.md5_factors(u.select("song_id").distinct(), "song_id", DRAWN_RANK, "i", signed), [])


def _long_factors(df: DataFrame, key: str) -> DataFrame:
    return round_doubles(df.select(F.col(key).alias("id"), F.posexplode("f").alias("k", "value")))


@query("nmf_factors")
def q_nmf_factors(spark, sf_dir):
    """One multiplicative update of the item factors from drawn factors."""
    u = util_table(spark, sf_dir)
    f = drawn_factors(u, signed=False)
    return _long_factors(fa.nmf_items_step(u, f.users, f.items, fa.gram(f.users, "f")), "song_id")


@query("nmf_error")
def q_nmf_error(spark, sf_dir):
    """A whole fit: iterations, convergence, first and last error, errors on the observed cells."""
    u = util_table(spark, sf_dir)
    f = fa.nmf(u, fa.RANK)
    errs = fa.observed_errors(u, f)
    return round_doubles(errs.select(F.lit(f.iterations).alias("iterations"), F.lit(f.converged).alias("converged"), F.lit(float(f.errors[0])).alias("first_err"),
                                     F.lit(float(f.errors[-1])).alias("reconstruction_err"), "*"))


def round_scores(top: DataFrame) -> DataFrame:
    """Scores to six digits in binary arithmetic, as the SQL's engine rounds; ``round`` goes by the decimal digits and differs at halves."""
    return top.withColumn("pred", F.signum("pred") * F.floor(F.abs("pred") * 1e6 + 0.5) / 1e6)


@query("nmf_top_n")
def q_nmf_top_n(spark, sf_dir):
    u = util_table(spark, sf_dir)
    return round_scores(fa.factor_top_n(u, drawn_factors(u, signed=False)))


@query("svd_factors")
def q_svd_factors(spark, sf_dir):
    """One product of the ratings with drawn item factors: the step of the range finder."""
    u = util_table(spark, sf_dir)
    return _long_factors(fa.user_product(u, drawn_factors(u, signed=True).items), "uid")


@query("svd_error")
def q_svd_error(spark, sf_dir):
    """A whole fit: rank, largest singular value, errors on the observed cells."""
    u = util_table(spark, sf_dir)
    f = fa.svd(u, fa.RANK)
    errs = fa.observed_errors(u, f)
    return round_doubles(errs.select(F.lit(len(f.errors)).alias("rank"), F.lit(float(f.errors[0])).alias("top_singular_value"), "*"))


@query("svd_user_errors")
def q_svd_user_errors(spark, sf_dir):
    u = util_table(spark, sf_dir)
    return round_doubles(ev_.user_errors(fa.reconstruct_observed(u, drawn_factors(u, signed=True))))


@query("svd_top_n_all")
def q_svd_top_n_all(spark, sf_dir):
    """Signed factors, all users."""
    u = util_table(spark, sf_dir)
    return round_scores(fa.factor_top_n(u, drawn_factors(u, signed=True)))


@query("svd_top_n")
def q_svd_top_n(spark, sf_dir):
    """For a table of chosen users only, as its SQL has it; ``svd_top_n_all`` takes all."""
    u = util_table(spark, sf_dir)
    chosen = u.select("uid").distinct().where(F.col("uid") % 10 == 0)
    return round_scores(fa.factor_top_n(u, drawn_factors(u, signed=True), users=chosen))


@query("svd_top_n_fitted")
def q_svd_top_n_fitted(spark, sf_dir):
    """Recommendations for all users from a whole fit, as the reference's notebook makes them for one."""
    u = util_table(spark, sf_dir)
    return round_scores(fa.factor_top_n(u, fa.svd(u, fa.RANK)))


@query("nmf_top_n_fitted")
def q_nmf_top_n_fitted(spark, sf_dir):
    """The same from an NMF fit, of a smaller rank and fewer iterations than ``nmf_error``'s, which is the whole of it."""
    u = util_table(spark, sf_dir)
    return round_scores(fa.factor_top_n(u, fa.nmf(u, FITTED_RANK, max_iter=FITTED_ITERATIONS)))


@query("svd_roundtrip")
def q_svd_roundtrip(spark, sf_dir):
    """The factor product against that of users projected again, over the observed cells."""
    u = util_table(spark, sf_dir)
    f, rows = drawn_factors(u, signed=True), u.count()
    again = fa.project_users(u, f)
    if rows <= PART_ROWS:
        return round_doubles(ev_.difference_sum(fa.reconstruct_observed(u, f), fa.reconstruct_observed(u, again), rows), 4)
    # written one after the other, so that the shuffles of one step are gone before the next
    again.users = store(again.users, "factors")[0]
    first, second = (store(fa.reconstruct_observed(u, x).select("uid", "song_id", "pred"), "products")[0] for x in (f, again))
    return round_doubles(ev_.difference_sum(first, second, rows), 4)


# --------------------------------------------------------- sources and sinks

def log_round_trip(spark, sf_dir, codec="none"):
    """The three kinds' daily files, written, read back by name and date, parsed and united."""
    return evx.unify(*[logs.read_text_logs(spark, landing.land_logs(spark, sf_dir, kind, codec), kind) for kind in ("play", "down", "search")])


@query("text_log_roundtrip")
def q_text_round_trip(spark, sf_dir):
    return log_round_trip(spark, sf_dir)


@query("gzip_log_roundtrip")
def q_gzip_round_trip(spark, sf_dir):
    return log_round_trip(spark, sf_dir, "gzip")


@query("archive_roundtrip")
def q_archive_round_trip(spark, sf_dir):
    """Archives of the play log's days, written as files, found by name, streamed and parsed."""
    return round_doubles(logs.read_archives(spark, landing.land_archives(spark, sf_dir, "play"), "play"))


@query("archive_event_log")
def q_archive_event_log(spark, sf_dir):
    """The three kinds' archives (Latin-1 in two of them), read and united."""
    return evx.unify(*[logs.read_archives(spark, landing.land_archives(spark, sf_dir, kind), kind) for kind in ("play", "down", "search")])


@query("event_table_roundtrip")
def q_event_table(spark, sf_dir):
    """From raw files to the date-partitioned event table, and back with the date pruned."""
    path = shared_path(spark, "events")
    evx.write_partitioned(log_round_trip(spark, sf_dir), path)
    return ex.count_by(spark.read.parquet(path).where(in_range("date", RANGE_START, RANGE_END)), "date", "event")


@query("download_song_names")
def q_download_names(spark, sf_dir):
    """Names out of the Latin-1 download logs, a field that the cleaned table leaves out."""
    lines_ = logs.read_text_lines(spark, landing.land_logs(spark, sf_dir, "down"), "down")
    return lines_.groupBy(logs.parse_yyyymmdd(logs.file_date(F.col("_file"))).alias("date"), logs.raw_field("down", "song_name").alias("song_name")).agg(F.count(F.lit(1)).alias("n"))


@query("cleaned_tables_roundtrip")
def q_cleaned_tables(spark, sf_dir):
    """K1: from raw files to a cleaned table for each kind, by date on disk, and back; rows, users and devices of each kind and day."""
    parts = []
    for kind in ("play", "down", "search"):
        path = shared_path(spark, f"clean-{kind}")
        evx.write_partitioned(logs.read_text_logs(spark, landing.land_logs(spark, sf_dir, kind), kind), path)
        parts.append(spark.read.parquet(path).groupBy(F.lit(kind).alias("kind"), "date").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("uid").alias("users"), F.count_if(F.col("device") == "ip").alias("ip")))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


CSV_SCHEMA = "uid long, device string, song_name string, song_id long, date date, play_time double, song_length double"


def csv_plays(spark, sf_dir):
    """The cleaned play table as CSV, with names that hold quotes, commas and line breaks; its path."""
    name = F.concat(F.lit('say "'), F.coalesce(F.col("song_id").cast("string"), F.lit("")), F.lit('", caf\u00e9\nagain'))
    path = shared_path(spark, "plays-csv")
    logs.write_clean_csv(src.play_log(spark, sf_dir).withColumn("song_name", name).select("uid", "device", "song_name", "song_id", "date", "play_time", "song_length"), path)
    return path


@query("csv_roundtrip")
def q_csv(spark, sf_dir):
    """The CSV under a schema."""
    return round_doubles(logs.read_clean_csv(spark, csv_plays(spark, sf_dir), CSV_SCHEMA, multi_line=True))


@query("csv_as_strings")
def q_csv_strings(spark, sf_dir):
    """Every column a string."""
    return logs.read_clean_csv(spark, csv_plays(spark, sf_dir), multi_line=True).select("uid", "device", "song_name", "song_id", "date")


@query("csv_inferred")
def q_csv_inferred(spark, sf_dir):
    """Sums by day over inferred types, with the type that each column got."""
    plays = logs.read_clean_csv(spark, csv_plays(spark, sf_dir), infer=True, multi_line=True)
    kinds = dict(plays.dtypes)
    sums = plays.groupBy("date").agg(F.sum("uid").alias("uid"), F.sum("song_id").alias("song_id"), F.sum("play_time").alias("play_time"))
    return round_doubles(sums.withColumn("types", F.lit(",".join(kinds[c] for c in ("uid", "song_name", "date", "play_time")))), 4)


@query("plays_table_roundtrip")
def q_plays_table(spark, sf_dir):
    path = shared_path(spark, "plays")
    pop.plays_per_user(src.play_log(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@query("training_table_roundtrip")
def q_training_table_file(spark, sf_dir):
    path = shared_path(spark, "training")
    tr.write_training_table(tr.training_table(events(spark, sf_dir), W, ACTIVITY), path)
    return round_doubles(spark.read.parquet(path))


@query("training_table_day_states")
def q_training_day_states(spark, sf_dir):
    """The training table merged from written day states."""
    path = shared_path(spark, "day-states")
    ds.write_day_states(events(spark, sf_dir), path)
    return round_doubles(ds.training_table_from_states(spark.read.parquet(path), W, ACTIVITY))


def day_sketches(spark, sf_dir):
    path = shared_path(spark, "day-sketches")
    sk.write_day_sketches(events(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("distinct_users_by_range")
def q_distinct_by_range(spark, sf_dir):
    """Users of each trailing window and of the label window, from day sketches alone; up to 2**16 users the numbers are exact."""
    ranges = [(f"last_{n}", W.snapshot - dt.timedelta(n - 1), W.snapshot) for n in W.sub_windows] + [("label", W.label_start, W.label_end)]
    return sk.distinct_users(day_sketches(spark, sf_dir), ranges)


@query("retention_by_event")
def q_retention(spark, sf_dir):
    """Of each event kind: users of the feature window, those who came back in the label window, and those who didn't."""
    return sk.retention(day_sketches(spark, sf_dir), (W.feature_start, W.feature_end), (W.label_start, W.label_end), "event")


@query("heavy_songs")
def q_heavy_songs(spark, sf_dir):
    """Songs with more than 1 % of the song events of the feature window: candidates from day summaries, counted exactly."""
    songs = events(spark, sf_dir).where("song_id is not null").select("date", "song_id")
    path = shared_path(spark, "day-heavy")
    sk.write_heavy_summaries(songs, "song_id", path, HEAVY_SHARE)
    return sk.heavy_hitters(songs, spark.read.parquet(path), "song_id", W.feature_start, W.feature_end, HEAVY_SHARE)


@query("training_table_bucketed")
def q_training_bucketed(spark, sf_dir):
    """The training table from an event table bucketed by uid: no exchange after the table is written."""
    path = shared_path(spark, "events-by-uid")
    table = evx.write_bucketed(events(spark, sf_dir), "tunetrail_events_" + uuid.uuid4().hex, path, BUCKETS)
    return round_doubles(tr.training_table(table, W, ACTIVITY))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn training table (label + all behaviour features), fused form."""
    return q_training_fused(spark, sf_dir)


__all__ = ["QUERIES", "flagship"]

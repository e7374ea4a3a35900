"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on views named after the driver's tables.  The SQL is
written independently of the DataFrame code -- same semantics, different
engine -- so a match checks both.  It imports nothing of the library.
"""

from __future__ import annotations

import datetime as dt

from typing import NamedTuple


class Windows(NamedTuple):
    label_start: dt.date
    label_end: dt.date
    feature_start: dt.date
    feature_end: dt.date
    snapshot: dt.date
    sub_windows: tuple[int, ...]


# The windows as literal dates, so that a wrong boundary in the library can't match itself.
W = Windows(dt.date(2024, 1, 28), dt.date(2024, 1, 30), dt.date(2024, 1, 14), dt.date(2024, 1, 27), dt.date(2024, 1, 27), (1, 3, 7, 14))

EV = """ev AS (
  SELECT user_id AS uid,
         CASE event_type WHEN 'purchase' THEN 'P' WHEN 'click' THEN 'D' WHEN 'view' THEN 'S' END AS event,
         CASE WHEN event_type <> 'view' THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS song_id,
         CAST(ts AS DATE) AS date,
         CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'ip' ELSE 'ar' END AS device,
         CASE WHEN event_type = 'purchase' THEN value END AS play_time,
         CASE WHEN event_type = 'purchase'
              THEN CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE) END AS song_length
  FROM events WHERE event_type IN ('purchase', 'click', 'view'))"""


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def trailing(w: Windows, n: int) -> str:
    return f"date BETWEEN {d(w.snapshot - dt.timedelta(n - 1))} AND {d(w.snapshot)}"


def feat(w: Windows) -> str:
    return f"date BETWEEN {d(w.feature_start)} AND {d(w.feature_end)}"


def lab(w: Windows) -> str:
    return f"date BETWEEN {d(w.label_start)} AND {d(w.label_end)}"


def freq_cols(w: Windows, events=("P", "D", "S"), fill=True) -> list[str]:
    out = []
    for e in events:
        for n in w.sub_windows:
            out.append(f"CAST(count(*) FILTER (WHERE event = '{e}' AND {trailing(w, n)}) AS BIGINT)"
                       f" AS freq_{e}_last_{n}")
    return out


def rec_cols(w: Windows, fill=True) -> list[str]:
    out = []
    for e in ("S", "D", "P"):
        x = f"date_diff('day', max(date) FILTER (WHERE event = '{e}' AND {feat(w)}), {d(w.snapshot)})"
        if fill:
            x = f"COALESCE({x}, 0)"
        out.append(f"CAST({x} AS INTEGER) AS rec_{e}")
    return out


def time_cols(w: Windows, fill=True) -> list[str]:
    out = []
    for n in w.sub_windows:
        x = f"sum(play_time) FILTER (WHERE event = 'P' AND {trailing(w, n)})"
        if fill:
            x = f"COALESCE({x}, 0)"
        out.append(f"round(CAST({x} AS DOUBLE), 6) AS total_time_last_{n}")
    return out


def perc_cols(w: Windows) -> list[str]:
    return [f"CAST(count(*) FILTER (WHERE event = 'P' AND {trailing(w, n)}"
            f" AND play_time / NULLIF(song_length, 0) > 0.8) AS BIGINT) AS play_perc_in_last{n}"
            for n in w.sub_windows]


def device_col(w: Windows, fill=True) -> str:
    x = f"min(CASE WHEN device = 'ip' THEN 1 ELSE 2 END) FILTER (WHERE event = 'P' AND {feat(w)})"
    if fill:
        x = f"COALESCE({x}, 0)"
    return f"CAST({x} AS INTEGER) AS device_type"


def training_sql(w: Windows = W, act: str = "event = 'P'") -> str:
    cols = ",\n  ".join(freq_cols(w) + rec_cols(w) + time_cols(w) + perc_cols(w) + [device_col(w)])
    return f"""WITH {EV}
SELECT uid,
  CAST(1 - max(CASE WHEN {act} AND {lab(w)} THEN 1 ELSE 0 END) AS INTEGER) AS label,
  {cols}
FROM ev WHERE date BETWEEN {d(w.feature_start)} AND {d(w.label_end)}
GROUP BY uid
HAVING max(CASE WHEN {act} AND {feat(w)} THEN 1 ELSE 0 END) = 1"""


def label_sql(w: Windows = W, act: str = "event = 'P'") -> str:
    return f"""WITH {EV},
pop AS (SELECT DISTINCT uid FROM ev WHERE {act} AND {feat(w)}),
act AS (SELECT DISTINCT uid FROM ev WHERE {act} AND {lab(w)})
SELECT pop.uid, CAST(CASE WHEN act.uid IS NULL THEN 1 ELSE 0 END AS INTEGER) AS label
FROM pop LEFT JOIN act ON pop.uid = act.uid"""


SQL: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    SQL[name] = sql


register("training_table_fused", training_sql())
register("training_table_chained", training_sql())
register("model_population", f"WITH {EV} SELECT DISTINCT uid FROM ev WHERE event = 'P' AND {feat(W)}")
register("churn_label", label_sql())
register("label_balance", f"""WITH lbl AS ({label_sql()})
SELECT label, CAST(count(*) AS BIGINT) AS n FROM lbl GROUP BY label""")

# ------------------------------------------------------------- exploration
register("event_count", f"WITH {EV} SELECT CAST(count(*) AS BIGINT) AS n FROM ev")
register("distinct_users", f"WITH {EV} SELECT CAST(count(DISTINCT uid) AS BIGINT) AS distinct_uid FROM ev")
register("count_by_event", f"WITH {EV} SELECT event, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY event")
register("multi_agg_by_event", f"""WITH {EV}
SELECT event, CAST(count(*) AS BIGINT) AS n, max(uid) AS max_uid, min(uid) AS min_uid,
       round(avg(uid), 6) AS avg_uid
FROM ev GROUP BY event""")
register("range_by_date_event", f"""WITH {EV}
SELECT date, event, CAST(count(*) AS BIGINT) AS n FROM ev
WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-05' GROUP BY date, event ORDER BY date, event""")
register("daily_count", f"WITH {EV} SELECT date, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY date")
_cols = ["uid", "event", "song_id", "date", "device", "play_time", "song_length"]
register("null_report", f"WITH {EV} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n_non_null, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS n_null FROM ev" for c in _cols))
PPU = f"""{EV}, ppu AS (SELECT uid, CAST(count(*) AS BIGINT) AS n_plays FROM ev
                  WHERE event = 'P' AND uid IS NOT NULL GROUP BY uid)"""
register("summary_stats", f"""WITH {PPU}
SELECT CAST(count(n_plays) AS BIGINT) AS count, round(avg(n_plays), 6) AS mean,
       round(stddev_samp(n_plays), 6) AS std, round(CAST(min(n_plays) AS DOUBLE), 6) AS min,
       round(quantile_cont(n_plays, 0.25), 6) AS q25, round(quantile_cont(n_plays, 0.5), 6) AS q50,
       round(quantile_cont(n_plays, 0.75), 6) AS q75, round(CAST(max(n_plays) AS DOUBLE), 6) AS max
FROM ppu""")
register("preview_ordered", f"""WITH {EV}
SELECT * FROM ev ORDER BY date NULLS FIRST, uid NULLS FIRST, event NULLS FIRST, song_id NULLS FIRST,
  device NULLS FIRST, play_time NULLS FIRST, song_length NULLS FIRST LIMIT 20""")

# -------------------------------------------------------------- population
register("plays_per_user", f"WITH {PPU} SELECT * FROM ppu")
register("plays_percentile", f"WITH {PPU} SELECT round(quantile_cont(n_plays, 0.999), 6) AS threshold FROM ppu")
BOTS = f"""{PPU}, bots AS (SELECT uid, n_plays FROM ppu
                   WHERE n_plays < (SELECT quantile_cont(n_plays, 0.999) FROM ppu))"""
register("bots_removed", f"WITH {BOTS} SELECT * FROM bots")
register("plays_log_histogram", f"""WITH {PPU}
SELECT CAST(least(floor(log10(CAST(n_plays AS DOUBLE)) * 5), 23) AS INTEGER) AS bin,
       CAST(count(*) AS BIGINT) AS n,
       round(CAST(least(floor(log10(CAST(n_plays AS DOUBLE)) * 5), 23) AS INTEGER) / 5.0, 6) AS bin_start
FROM ppu WHERE log10(CAST(n_plays AS DOUBLE)) BETWEEN 0 AND 4.8 GROUP BY 1, 3""")
SAMPLE = "(('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8))::BIGINT % 10000) < 1000"
SAMPLED = f"""{BOTS}, sampled AS (SELECT uid FROM bots WHERE {SAMPLE.format(c='uid')})"""
register("user_hash_sample", f"WITH {SAMPLED} SELECT uid FROM sampled")
register("sampled_events", f"WITH {SAMPLED} SELECT * FROM ev WHERE uid IN (SELECT uid FROM sampled)")

# ------------------------------------------------------------------ events
register("event_log_union", f"WITH {EV} SELECT uid, event, song_id, date FROM ev")
register("distinct_user_device", f"WITH {EV} SELECT DISTINCT uid, device FROM ev WHERE event = 'P' AND {feat(W)}")
register("users_multi_device", f"""WITH {EV}
SELECT uid, CAST(count(DISTINCT device) AS BIGINT) AS n_devices FROM ev WHERE event = 'P' AND {feat(W)}
GROUP BY uid HAVING count(DISTINCT device) > 1""")
register("parse_log_lines", """
SELECT user_id AS uid,
       CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'ip' ELSE 'ar' END AS device,
       'song ' || json_extract_string(props, '$.k') AS song_name,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS song_id,
       CAST(ts AS DATE) AS date,
       CASE WHEN event_id % 10 IN (7, 8) THEN NULL ELSE round(CAST(printf('%.2f', value) AS DOUBLE), 6) END AS play_time,
       round(CAST(json_extract_string(props, '$.k') AS DOUBLE), 6) AS song_length
FROM events WHERE event_type = 'purchase' AND event_id % 10 NOT IN (1, 3, 5, 6)""")

# ---------------------------------------------------------------- features
register("freq_single_window", f"""WITH {EV}
SELECT uid, CAST(count(*) AS BIGINT) AS freq_S_last_3 FROM ev
WHERE event = 'S' AND {trailing(W, 3)} GROUP BY uid""")
register("freq_all_windows", f"WITH {EV} SELECT uid, {', '.join(freq_cols(W))} FROM ev WHERE {feat(W)} GROUP BY uid")
register("recency", f"WITH {EV} SELECT uid, {', '.join(rec_cols(W, fill=False))} FROM ev WHERE {feat(W)} GROUP BY uid")
register("recency_sorted_array", f"""WITH {EV}
SELECT uid, array_to_string(list_sort(list(DISTINCT event)), ',') AS events,
       max(date) FILTER (WHERE event = 'P') AS last_date,
       CAST(date_diff('day', max(date) FILTER (WHERE event = 'P'), {d(W.snapshot)}) AS INTEGER) AS rec_P
FROM ev WHERE {feat(W)} GROUP BY uid""")
register("play_time_windows", f"""WITH {EV}
SELECT uid, {', '.join(time_cols(W, fill=False))} FROM ev WHERE event = 'P' AND {feat(W)} GROUP BY uid""")
register("play_ratio_windows", f"WITH {EV} SELECT uid, {', '.join(perc_cols(W))} FROM ev WHERE event = 'P' AND {feat(W)} GROUP BY uid")
register("device_profile", f"""WITH {EV}
SELECT uid, CAST(min(CASE WHEN device = 'ip' THEN 1 ELSE 2 END) AS INTEGER) AS device_type
FROM ev WHERE event = 'P' AND {feat(W)} GROUP BY uid""")
register("device_profile_fanout", f"""WITH {EV},
pop AS (SELECT DISTINCT uid FROM ev WHERE event = 'P' AND {feat(W)}),
prof AS (SELECT DISTINCT uid, CAST(CASE WHEN device = 'ip' THEN 1 ELSE 2 END AS INTEGER) AS device_type
         FROM (SELECT DISTINCT uid, device FROM ev WHERE event = 'P' AND {feat(W)}))
SELECT prof.device_type, CAST(count(*) AS BIGINT) AS n FROM pop LEFT JOIN prof ON pop.uid = prof.uid
GROUP BY prof.device_type""")
register("device_dummies", f"""WITH t AS ({training_sql()})
SELECT uid, CAST(CASE WHEN device_type = 1 THEN 1 ELSE 0 END AS INTEGER) AS device_type_1,
            CAST(CASE WHEN device_type = 2 THEN 1 ELSE 0 END AS INTEGER) AS device_type_2 FROM t""")
SPLIT = "CASE WHEN (('0x' || substr(md5(CAST(uid AS VARCHAR) || 'split'), 1, 8))::BIGINT % 10000) < 2000 THEN 'test' ELSE 'train' END"
register("train_test_split", f"WITH lbl AS ({label_sql()}) SELECT uid, {SPLIT} AS split FROM lbl")

# ------------------------------------------------------------- recommender
NAMED = f"""touch AS (SELECT user_id AS uid, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS song_id,
  CAST(ts AS DATE) AS date FROM events),
named AS (SELECT touch.uid, touch.song_id, part.p_name AS song_name, touch.date FROM touch
  LEFT JOIN part ON part.p_partkey = touch.song_id),
win AS (SELECT * FROM named WHERE uid IS NOT NULL AND song_id IS NOT NULL AND song_name IS NOT NULL
        AND date IS NOT NULL AND date > DATE '2024-01-24' AND date <= DATE '2024-01-30'),
act AS (SELECT uid, CAST(count(*) AS BIGINT) AS plays FROM win GROUP BY uid HAVING count(*) > 5),
by_user AS (SELECT * FROM win WHERE uid IN (SELECT uid FROM act)),
songs AS (SELECT song_id, CAST(count(*) AS BIGINT) AS plays FROM by_user GROUP BY song_id HAVING count(*) > 2),
inter AS (SELECT * FROM by_user WHERE song_id IN (SELECT song_id FROM songs))"""
register("interactions", f"WITH {NAMED} SELECT uid, song_id, song_name, date FROM inter")
register("active_users", f"WITH {NAMED} SELECT * FROM act")
register("popular_songs", f"WITH {NAMED} SELECT * FROM songs")
register("play_counts", f"""WITH {NAMED}
SELECT uid, song_id, song_name, CAST(count(*) AS BIGINT) AS counts FROM inter GROUP BY uid, song_id, song_name""")
RATED = """cnt AS (SELECT o.o_custkey AS uid, l.l_partkey AS song_id, CAST(sum(l.l_quantity) AS BIGINT) AS counts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
rated AS (SELECT cnt.uid, cnt.song_id, p.p_name AS song_name, cnt.counts,
  CAST(CASE WHEN counts <= 0 THEN NULL WHEN counts <= 10 THEN 1 WHEN counts <= 20 THEN 2
            WHEN counts <= 30 THEN 3 WHEN counts <= 40 THEN 4 ELSE 5 END AS INTEGER) AS "like"
  FROM cnt LEFT JOIN part p ON p.p_partkey = cnt.song_id),
util AS (SELECT uid, song_id, avg("like") AS rating FROM rated GROUP BY uid, song_id),
norms AS (SELECT song_id, sum(rating * rating) AS n2 FROM util GROUP BY song_id),
sim AS (SELECT a.song_id AS item_i, b.song_id AS item_j,
               sum(a.rating * b.rating) / sqrt(any_value(ni.n2) * any_value(nj.n2)) AS sim
        FROM util a JOIN util b ON a.uid = b.uid
        JOIN norms ni ON ni.song_id = a.song_id JOIN norms nj ON nj.song_id = b.song_id
        GROUP BY a.song_id, b.song_id),
neigh AS (SELECT * FROM (SELECT item_i, item_j, sim,
            CAST(row_number() OVER (PARTITION BY item_i ORDER BY sim DESC, item_j DESC) AS INTEGER) AS rank
          FROM sim WHERE sim > 0) WHERE rank <= 75),
pred AS (SELECT u.uid, n.item_i AS song_id,
           round(COALESCE(sum(u.rating * n.sim) / NULLIF(sum(n.sim), 0), 0), 6) AS pred
         FROM neigh n JOIN util u ON u.song_id = n.item_j GROUP BY u.uid, n.item_i),
names AS (SELECT song_id, min(song_name) AS song_name FROM rated GROUP BY song_id)"""
register("ratings", f"WITH {RATED} SELECT * FROM rated")
register("utility", f"WITH {RATED} SELECT * FROM util")
register("song_names", f"WITH {RATED} SELECT * FROM names")
register("utility_extent", f"""WITH {RATED}
SELECT max(uid) AS max_uid, max(song_id) AS max_song_id, CAST(count(DISTINCT uid) AS BIGINT) AS n_users,
       CAST(count(DISTINCT song_id) AS BIGINT) AS n_songs, CAST(count(*) AS BIGINT) AS n_cells FROM util""")
register("item_similarity", f"WITH {RATED} SELECT * FROM sim")
register("item_neighbours", f"WITH {RATED} SELECT * FROM neigh")
register("predicted_ratings", f"WITH {RATED} SELECT * FROM pred")
register("top_n_songs", f"""WITH {RATED},
unrated AS (SELECT * FROM pred p WHERE NOT EXISTS (SELECT 1 FROM util u WHERE u.uid = p.uid AND u.song_id = p.song_id)),
ranked AS (SELECT uid, song_id, pred,
             CAST(row_number() OVER (PARTITION BY uid ORDER BY pred DESC, song_id DESC) AS INTEGER) AS rank
           FROM unrated)
SELECT r.uid, r.song_id, r.pred, r.rank, names.song_name FROM ranked r LEFT JOIN names ON names.song_id = r.song_id
WHERE r.rank <= 10""")
ERR = f"""{RATED}, means AS (SELECT song_id, avg(rating) AS pred FROM util GROUP BY song_id),
obs AS (SELECT u.uid, u.song_id, u.rating, m.pred FROM util u JOIN means m ON m.song_id = u.song_id WHERE u.rating > 0)"""
register("masked_errors", f"""WITH {ERR}
SELECT CAST(count(*) AS BIGINT) AS n, round(avg((rating - pred) * (rating - pred)), 6) AS mse,
       round(avg(abs(rating - pred)), 6) AS mae FROM obs""")
register("user_errors", f"""WITH {ERR}
SELECT uid, CAST(count(*) AS BIGINT) AS n, round(avg(abs(rating - pred)), 6) AS mae FROM obs GROUP BY uid""")

# ----------------------------------------------------------------- metrics
SCORED = f"""t AS ({training_sql()}),
scored AS (SELECT uid, label, (freq_S_last_14 % 11) / 10.0 AS p, {SPLIT} AS split FROM t),
grp AS (SELECT split, p, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
        FROM scored GROUP BY split, p),
cum AS (SELECT split, p, pos, neg,
          COALESCE(sum(pos) OVER (PARTITION BY split ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
          COALESCE(sum(neg) OVER (PARTITION BY split ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM grp),
auc AS (SELECT split, COALESCE(sum(pos * (neg_below + neg / 2.0)) / NULLIF(CAST(sum(pos) * sum(neg) AS DOUBLE), 0), 0) AS auc
        FROM cum GROUP BY split)"""
register("roc_auc", f"WITH {SCORED} SELECT split, round(auc, 6) AS auc FROM auc")
register("roc_curve", f"""WITH {SCORED}, tot AS (SELECT split, sum(pos) AS n_pos, sum(neg) AS n_neg FROM grp GROUP BY split)
SELECT c.split, round(c.p, 6) AS threshold,
       round(COALESCE((t.n_pos - c.pos_below) / NULLIF(CAST(t.n_pos AS DOUBLE), 0), 0), 6) AS tpr,
       round(COALESCE((t.n_neg - c.neg_below) / NULLIF(CAST(t.n_neg AS DOUBLE), 0), 0), 6) AS fpr
FROM cum c JOIN tot t ON t.split = c.split""")
register("classification_metrics", f"""WITH {SCORED},
cm AS (SELECT split,
  CAST(count(*) FILTER (WHERE p > 0.5 AND label = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE p > 0.5 AND label = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE NOT p > 0.5 AND label = 1) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE NOT p > 0.5 AND label = 0) AS BIGINT) AS tn FROM scored GROUP BY split)
SELECT cm.split, tp, fp, fn, tn,
  round(COALESCE((tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0), 0), 6) AS accuracy,
  round(COALESCE(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS precision,
  round(COALESCE(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall,
  round(COALESCE(2 * tp / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1,
  round(auc.auc, 6) AS auc
FROM cm JOIN auc ON auc.split = cm.split""")

# ------------------------------------------------------------ profiling
register("event_info", f"""WITH {EV}
SELECT c AS column_name, t AS type, CAST(count(v) AS BIGINT) AS n_non_null, CAST(count(*) - count(v) AS BIGINT) AS n_null FROM (
  SELECT unnest(['uid', 'event', 'song_id', 'date', 'device', 'play_time', 'song_length']) AS c,
         unnest(['bigint', 'string', 'bigint', 'date', 'string', 'double', 'double']) AS t,
         unnest([CAST(uid AS VARCHAR), event, CAST(song_id AS VARCHAR), CAST(date AS VARCHAR), device, CAST(play_time AS VARCHAR), CAST(song_length AS VARCHAR)]) AS v
  FROM ev) GROUP BY c, t""")
_STAT = """SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM ev WHERE event = 'P'"""
register("describe_plays", f"WITH {EV} " + " UNION ALL ".join(_STAT.format(c=c) for c in ("uid", "song_id", "play_time", "song_length")))
register("song_value_counts", f"WITH {RATED} SELECT song_id, CAST(count(*) AS BIGINT) AS n FROM rated GROUP BY song_id")
register("rating_value_counts", f"""WITH {RATED} SELECT "like", CAST(count(*) AS BIGINT) AS n FROM rated GROUP BY "like\"""")
register("utility_pivot", f"WITH {RATED} SELECT uid, " + ", ".join(f"COALESCE(max(rating) FILTER (song_id = {i}), 0.0) AS song_{i}" for i in range(1, 6)) + " FROM util GROUP BY uid")
register("top_n_songs_chosen", f"""WITH {RATED},
unrated AS (SELECT * FROM pred p WHERE uid % 10 = 0 AND NOT EXISTS (SELECT 1 FROM util u WHERE u.uid = p.uid AND u.song_id = p.song_id)),
ranked AS (SELECT uid, song_id, pred, CAST(row_number() OVER (PARTITION BY uid ORDER BY pred DESC, song_id DESC) AS INTEGER) AS rank FROM unrated)
SELECT r.uid, r.song_id, r.pred, r.rank, names.song_name FROM ranked r LEFT JOIN names ON names.song_id = r.song_id WHERE r.rank <= 10""")

# ------------------------------------------------------- models, factors
_SCORE_ROWS = f"""WITH t AS ({training_sql()}) SELECT uid, label, {SPLIT} AS split, true AS is_probability FROM t"""
for _name in ("logistic_scores", "forest_scores", "gbt_scores", "mlp_scores", "relu_net_scores", "grid_search"):
    register(_name, _SCORE_ROWS)


def _drawn(ids: str, key: str, salt: str, signed: bool) -> str:
    u = f"('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR) || ':' || CAST(k AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    return f"SELECT {key}, k, {f'{u} * 2.0 - 1.0' if signed else u} AS v FROM (SELECT DISTINCT {key} FROM {ids}), unnest(range(0, 8)) t(k)"


_POSITIVE = f"{RATED}, w AS ({_drawn('util', 'uid', 'u', False)}), h AS ({_drawn('util', 'song_id', 'i', False)})"
_SIGNED = f"{RATED}, w AS ({_drawn('util', 'uid', 'u', True)}), h AS ({_drawn('util', 'song_id', 'i', True)})"
register("nmf_factors", f"""WITH {_POSITIVE},
num AS (SELECT song_id, k, sum(rating * v) AS x FROM util JOIN w USING (uid) GROUP BY song_id, k),
g AS (SELECT a.k AS k, b.k AS l, sum(a.v * b.v) AS x FROM w a JOIN w b USING (uid) GROUP BY a.k, b.k),
den AS (SELECT h.song_id, g.k, sum(h.v * g.x) AS x FROM h JOIN g ON g.l = h.k GROUP BY h.song_id, g.k)
SELECT h.song_id AS id, CAST(h.k AS INTEGER) AS k, round(h.v * num.x / (den.x + 1e-10), 6) AS value
FROM h JOIN num USING (song_id, k) JOIN den USING (song_id, k)""")
register("svd_factors", f"WITH {_SIGNED} SELECT uid AS id, CAST(k AS INTEGER) AS k, round(sum(rating * v), 6) AS value FROM util JOIN h USING (song_id) GROUP BY uid, k")
_PRED = "p AS (SELECT util.uid, util.song_id, rating, sum(w.v * h.v) AS pred FROM util JOIN w USING (uid) JOIN h ON h.song_id = util.song_id AND h.k = w.k GROUP BY 1, 2, 3)"
register("svd_user_errors", f"WITH {_SIGNED}, {_PRED} SELECT uid, CAST(count(*) AS BIGINT) AS n, round(avg(abs(rating - pred)), 6) AS mae FROM p GROUP BY uid")
register("svd_roundtrip", f"""WITH {_SIGNED}, {_PRED},
w2 AS (SELECT uid, k, sum(rating * v) AS v FROM util JOIN h USING (song_id) GROUP BY uid, k),
q AS (SELECT util.uid, util.song_id, sum(w2.v * h.v) AS pred FROM util JOIN w2 USING (uid) JOIN h ON h.song_id = util.song_id AND h.k = w2.k GROUP BY 1, 2)
SELECT round(sum(p.pred - q.pred), 4) AS diff_sum, round(max(abs(p.pred - q.pred)), 4) AS max_abs_diff FROM p JOIN q USING (uid, song_id)""")
_TOP = """, sc AS (SELECT w.uid, h.song_id, round(sum(w.v * h.v), 9) AS pred FROM w JOIN h USING (k) WHERE {cut} GROUP BY 1, 2),
r AS (SELECT uid, song_id, pred, CAST(row_number() OVER (PARTITION BY uid ORDER BY pred DESC, song_id DESC) AS INTEGER) AS rank
      FROM sc WHERE NOT EXISTS (SELECT 1 FROM util u WHERE u.uid = sc.uid AND u.song_id = sc.song_id))
SELECT uid, song_id, round(pred, 6) AS pred, rank FROM r WHERE rank <= 10"""
register("nmf_top_n", f"WITH {_POSITIVE}" + _TOP.format(cut="true"))
register("svd_top_n_all", f"WITH {_SIGNED}" + _TOP.format(cut="true"))
register("svd_top_n", f"WITH {_SIGNED}" + _TOP.format(cut="w.uid % 10 = 0"))

# ------------------------------------------------------ sources and sinks
for _name in ("text_log_roundtrip", "gzip_log_roundtrip", "archive_event_log"):
    register(_name, f"WITH {EV} SELECT uid, event, song_id, date FROM ev")
register("archive_roundtrip", f"WITH {EV} SELECT uid, device, 'caf\u00e9' AS song_name, song_id, date, round(play_time, 6) AS play_time, round(song_length, 6) AS song_length FROM ev WHERE event = 'P'")
register("event_table_roundtrip", f"WITH {EV} SELECT date, event, CAST(count(*) AS BIGINT) AS n FROM ev WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-05' GROUP BY date, event")
register("plays_table_roundtrip", SQL["plays_per_user"])
for _name in ("training_table_roundtrip", "training_table_day_states", "training_table_bucketed"):
    register(_name, SQL["training_table_fused"])

register("download_song_names", f"""WITH {EV} SELECT date, CASE COALESCE(song_id, 0) % 3 WHEN 0 THEN 'caf\u00e9' WHEN 1 THEN 'se\u00f1or \u00bd' ELSE 'na\u00efve \u00a35' END AS song_name,
  CAST(count(*) AS BIGINT) AS n FROM ev WHERE event = 'D' GROUP BY 1, 2""")
register("cleaned_tables_roundtrip", f"""WITH {EV} SELECT CASE event WHEN 'P' THEN 'play' WHEN 'D' THEN 'down' ELSE 'search' END AS kind, date, CAST(count(*) AS BIGINT) AS n,
  CAST(count(DISTINCT uid) AS BIGINT) AS users, CAST(count(*) FILTER (WHERE device = 'ip') AS BIGINT) AS ip FROM ev GROUP BY 1, 2""")
_CSV_NAME = "'say \"' || COALESCE(CAST(song_id AS VARCHAR), '') || '\", caf\u00e9' || chr(10) || 'again' AS song_name"
register("csv_roundtrip", f"WITH {EV} SELECT uid, device, {_CSV_NAME}, song_id, date, round(play_time, 6) AS play_time, round(song_length, 6) AS song_length FROM ev WHERE event = 'P'")
register("csv_as_strings", f"WITH {EV} SELECT CAST(uid AS VARCHAR) AS uid, device, {_CSV_NAME}, CAST(song_id AS VARCHAR) AS song_id, CAST(date AS VARCHAR) AS date FROM ev WHERE event = 'P'")
register("csv_inferred", f"""WITH {EV} SELECT date, CAST(sum(uid) AS BIGINT) AS uid, CAST(sum(song_id) AS BIGINT) AS song_id, round(sum(play_time), 4) AS play_time, 'int,string,date,double' AS types
  FROM ev WHERE event = 'P' GROUP BY date""")

_RANGES = [(f"last_{n}", W.snapshot - dt.timedelta(days=n - 1), W.snapshot) for n in W.sub_windows] + [("label", W.label_start, W.label_end)]
register("distinct_users_by_range", f"WITH {EV} " + " UNION ALL ".join(
    f"SELECT '{n}' AS name, CAST(count(*) AS BIGINT) AS n_events, CAST(count(DISTINCT uid) AS BIGINT) AS n_users FROM ev WHERE date BETWEEN {d(a)} AND {d(b)}" for n, a, b in _RANGES))
register("retention_by_event", f"""WITH {EV}, u AS (SELECT event, uid, bool_or(date BETWEEN {d(W.feature_start)} AND {d(W.feature_end)}) AS a, bool_or(date BETWEEN {d(W.label_start)} AND {d(W.label_end)}) AS b FROM ev GROUP BY 1, 2)
SELECT event, CAST(count(*) FILTER (WHERE a) AS BIGINT) AS n_users, CAST(count(*) FILTER (WHERE a AND b) AS BIGINT) AS n_back, CAST(count(*) FILTER (WHERE a AND NOT b) AS BIGINT) AS n_left FROM u GROUP BY event HAVING bool_or(a OR b)""")
register("heavy_songs", f"""WITH {EV}, s AS (SELECT song_id FROM ev WHERE song_id IS NOT NULL AND date BETWEEN {d(W.feature_start)} AND {d(W.feature_end)})
SELECT song_id, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY song_id HAVING count(*) > 0.01::DOUBLE * (SELECT count(*) FROM s)""")

"""Raw play-log lines derived from the driver's ``events`` table.

The driver ships no text logs, so the line-parsing operators are exercised
on tab-separated lines that Spark builds from every purchase event.  A rule
on ``event_id`` puts the reference's trap values into some lines (every
line is kept; the parser decides):

====  =====================================================  =========
id%10 trap                                                   parser
====  =====================================================  =========
1     uid 'abc'                                              dropped
2     uid with surrounding blanks                            kept
3     date with month 13                                     dropped
4     date followed by extra characters                      kept
5     two fields missing (date slot empty)                   dropped
6     a tab inside song_name (date slot holds another field) dropped
7     play_time ''                                           kept, null
8     play_time 'abc'                                        kept, null
====  =====================================================  =========
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.sources.driver_tables import table


def play_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    trap = F.pmod(F.col("event_id"), F.lit(10))
    k = F.get_json_object("props", "$.k")
    uid = F.col("user_id").cast("string")
    uid_f = F.when(trap == 1, F.lit("abc")).when(trap == 2, F.concat(F.lit("  "), uid, F.lit(" "))).otherwise(uid)
    device = F.when(k.try_cast("bigint") % 2 == 0, "ip").otherwise("ar")
    name = F.when(trap == 6, F.concat(F.lit("song\t"), k)).otherwise(F.concat(F.lit("song "), k))
    pt = F.format_string("%.2f", F.col("value"))
    pt_f = F.when(trap == 7, F.lit("")).when(trap == 8, F.lit("abc")).otherwise(pt)
    ymd = F.date_format(F.col("ts"), "yyyyMMdd")
    date_f = (F.when(trap == 3, F.concat(F.date_format("ts", "yyyy"), F.lit("13"), F.date_format("ts", "dd")))
               .when(trap == 4, F.concat(ymd, F.lit("x"))).otherwise(ymd))
    head = [uid_f, device, k, F.lit("0"), name, F.lit("singer"), pt_f]
    tail = [k, F.lit("0")]
    body = F.when(trap == 5, F.concat_ws("\t", *head)).otherwise(F.concat_ws("\t", *head, *tail))
    # the shell step appends the date after a blank-tab-blank
    return ev.select(F.concat(body, F.lit(" \t "), date_f).alias("line"))

from __future__ import annotations

import datetime as dt

LOG_SCHEMA = ("timestamp timestamp, service string, host string, endpoint string, "
              "status_code int, latency_ms double, user_id string, trace_id string, "
              "region string")
DEPLOY_SCHEMA = "service string, version string, deploy_time timestamp"

DAY = dt.datetime(2024, 1, 1)


def t(h=0, m=0, s=0, us=0, day=0):
    return DAY + dt.timedelta(days=day, hours=h, minutes=m, seconds=s, microseconds=us)


def log(ts, *, service="svc", host="h1", endpoint="/e", status=200, latency=1.0,
        user="u", trace="t1", region="r1"):
    return (ts, service, host, endpoint, status, latency, user, trace, region)


def logs_df(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def deploys_df(spark, rows):
    return spark.createDataFrame(rows, DEPLOY_SCHEMA)

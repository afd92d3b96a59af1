"""Derive the three inputs (logs, host metadata, deployments) from the test tables.

Each input is derived from whole tables, so it grows with the scale factor:
one host per user (``h<user_id>``) and one host row per supplier, so users
without a supplier of the same number get region ``unknown``; every signup
event is a deployment.

The SELECT texts run unchanged in Spark SQL and in DuckDB; ``{events}`` etc.
are table names filled in per engine.  Spark reads the parquet files and
registers them under private view names; the oracle uses the plain names.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from opsfold.config import configure
from opsfold.sources.readers import Inputs, coerce_inputs

SOURCE_TABLES = ["events", "supplier", "nation", "region"]

LOGS_SQL = """
select ts as timestamp,
       'svc-' || cast(user_id % 4 as varchar(9)) as service,
       '/' || event_type as endpoint,
       'h' || cast(user_id as varchar(20)) as host,
       case when event_type = 'error' and event_id % 3 = 0 then 503
            when event_id % 10 = 0 then 404 else 200 end as status_code,
       value as latency_ms,
       'u' || cast(user_id as varchar(20)) as user_id,
       't' || cast((event_id - event_id % 4) as varchar(20)) as trace_id
from {events}
"""

# Skewed variant: every third event belongs to one user and one trace, so a
# single key holds a third of all rows (exercises hot-key splitting).
SKEWED_LOGS_SQL = """
select ts as timestamp,
       'svc-' || cast(user_id % 4 as varchar(9)) as service,
       '/' || event_type as endpoint,
       'h' || cast(user_id as varchar(20)) as host,
       case when event_type = 'error' and event_id % 3 = 0 then 503
            when event_id % 10 = 0 then 404 else 200 end as status_code,
       value as latency_ms,
       case when event_id % 3 = 0 then 'u-hot'
            else 'u' || cast(user_id as varchar(20)) end as user_id,
       case when event_id % 3 = 0 then 't-hot'
            else 't' || cast((event_id - event_id % 4) as varchar(20)) end as trace_id
from {events}
"""

HOSTS_SQL = """
select 'h' || cast(s_suppkey as varchar(20)) as host, r_name as region,
       'type-' || cast(s_suppkey % 3 as varchar(9)) as instance_type
from {supplier} join {nation} on s_nationkey = n_nationkey
              join {region} on n_regionkey = r_regionkey
"""

# Every signup event stands for a release of the user's service.
DEPLOYMENTS_SQL = """
select 'svc-' || cast(user_id % 4 as varchar(9)) as service,
       'v' || cast(event_id as varchar(20)) as version, ts as deploy_time
from {events} where event_type = 'signup'
"""

_PLAIN = {t: t for t in SOURCE_TABLES}
_SERVICE = "'svc-' || cast(user_id % 4 as varchar(9)) as service"
_HOST = "'h' || cast(user_id as varchar(20)) as host"
# Every third event belongs to one service (logs and deployments), or to one host.
_HOT_SERVICE = "case when event_id % 3 = 0 then 'svc-hot' else 'svc-' || cast(user_id % 4 as varchar(9)) end as service"
_HOT_HOST = "case when event_id % 3 = 0 then 'h1' else 'h' || cast(user_id as varchar(20)) end as host"


def fixture_sql(names: dict[str, str] | None = None, *, skewed: bool | str = False) -> dict[str, str]:
    """``skewed``: True for one hot user and trace, ``"service"`` or ``"host"`` for a hot one of these."""
    names = names or _PLAIN
    logs, deployments = LOGS_SQL, DEPLOYMENTS_SQL
    if skewed == "service":
        logs, deployments = (s.replace(_SERVICE, _HOT_SERVICE) for s in (logs, deployments))
    elif skewed == "host":
        logs = logs.replace(_HOST, _HOT_HOST)
    elif skewed:
        logs = SKEWED_LOGS_SQL
    return {"logs": logs.format(**names), "hosts": HOSTS_SQL.format(**names),
            "deployments": deployments.format(**names)}


def register_sources(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Register the source parquet tables as session views, once per folder.

    View names are derived from the folder, so later calls in the same session
    reuse the registered views (and their file listing and schema) instead of
    reading every footer again.
    """
    tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    names = {}
    for table in SOURCE_TABLES:
        view = f"_of_{table}_{tag}"
        if not spark.catalog.tableExists(view):
            path = os.path.join(sf_dir, f"{table}.parquet")
            spark.read.parquet(path).createOrReplaceTempView(view)
        names[table] = view
    return names


def raw_inputs(spark: SparkSession, sf_dir: str, *, skewed: bool | str = False) -> dict[str, DataFrame]:
    """The three inputs as derived (uncoerced) DataFrames."""
    sql = fixture_sql(register_sources(spark, sf_dir), skewed=skewed)
    return {name: spark.sql(text) for name, text in sql.items()}


def fixture_inputs(spark: SparkSession, sf_dir: str, *, skewed: bool | str = False) -> Inputs:
    """Derived inputs after the loader's coercion (time normalised, types forced)."""
    configure(spark)
    raw = raw_inputs(spark, sf_dir, skewed=skewed)
    return coerce_inputs(raw["logs"], raw["deployments"], raw["hosts"])


# Oracle side: the same derivation plus enrichment, as CTEs for DuckDB.
ORACLE_ENRICHED_SQL = """
host_ranked as (
  select host, region, instance_type,
         row_number() over (partition by host
                            order by region asc nulls last, instance_type asc nulls last) as rn
  from host_meta where host is not null
),
hosts1 as (select host, region, instance_type from host_ranked where rn = 1),
enriched as (
  select l.host, l.timestamp, l.service, l.endpoint, l.status_code, l.latency_ms,
         l.user_id, l.trace_id,
         coalesce(h.region, 'unknown') as region,
         coalesce(h.instance_type, 'unknown') as instance_type
  from logs l left join hosts1 h on l.host = h.host
)"""


def oracle_prefix(*, skewed: bool | str = False) -> str:
    """``WITH logs AS (...), host_meta AS (...), deployments AS (...), enriched AS (...)``."""
    sql = fixture_sql(skewed=skewed)
    return ("with logs as (" + sql["logs"] + "),\nhost_meta as (" + sql["hosts"]
            + "),\ndeployments as (" + sql["deployments"] + "),\n" + ORACLE_ENRICHED_SQL)

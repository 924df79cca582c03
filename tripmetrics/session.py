"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Times in the sources are wall-clock times without a zone. UTC has no gaps and no repeated hours,
# so parsing them as UTC and dropping the zone keeps every value as written.
SESSION_ZONE = "UTC"


def build_session(
    app: str, master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings below; ``conf`` adds to them or replaces them.

    On a cluster leave ``master`` unset and let ``spark-submit`` choose it. Shuffle partition counts
    are left to adaptive execution, which coalesces small ones and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": SESSION_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Set the zone on a session that someone else built."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark

"""Scenario projection: templates to perturbed, internally consistent observations.

Everything is a column expression over (template, replica), so the job is one
narrow stage, batch or streaming, and the same seed gives the same rows.
"""

from functools import reduce

from pyspark.sql import functions as F

from rateflow import schema as S
from rateflow.functions.draws import with_draws
from rateflow.functions.scalars import clamp, computed_once

# Calibration, caps and fallbacks of the projection.
DELAY_RATE_CALIBRATION = 1.085
DIVERT_RATE_CALIBRATION = 1.19
MAX_DELAY_RATE = 0.95
MAX_CANCEL_RATE = 0.20
MAX_DIVERT_RATE = 0.05
DEFAULT_MINUTES_PER_DELAYED = 55.0
DEFAULT_SHARES = [0.30, 0.06, 0.26, 0.002, 0.378]
SCENARIO_YEAR = 2025

DRAWS = 15


def _add(columns):
    return reduce(lambda a, b: a + b, columns)


def apportion(parts, target):
    """Adjust rounded parts to sum exactly to target.

    Too much is taken from the parts in order, never below zero; too little is
    added to the first part.
    """
    whole = _add(parts)
    zero = F.lit(0).cast("bigint")
    excess = whole - target
    adjusted, before = [], zero
    for part in parts:
        adjusted.append(part - F.least(part, F.greatest(excess - before, zero)))
        before = before + part
    adjusted[0] = adjusted[0] + F.greatest(target - whole, zero)
    return adjusted


def _whole(c):
    return F.round(c).cast("bigint")


def scenario(templates, replicas=1, seed=42, year=SCENARIO_YEAR, envelope=True):
    """Project every template `replicas` times. templates needs a template_id and the measures."""
    copies = templates.withColumn("replica", F.explode(F.sequence(F.lit(1), F.lit(replicas))))
    source = with_draws(copies, [F.col("template_id"), F.col("replica")], seed, DRAWS)

    def small(draw):
        return F.lit(0.90) + F.lit(0.20) * F.col(f"u{draw}")

    def wide(draw):
        return F.lit(0.85) + F.lit(0.30) * F.col(f"u{draw}")

    def scaled(values, draw, jitter):
        return values * jitter(draw)

    base = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in S.MEASURES}
    out = source.select(
        "template_id", "replica", *S.TEXT_COLUMNS,
        clamp(F.coalesce(F.nullif(F.col("month").cast("int"), F.lit(0)), F.lit(1)), F.lit(1), F.lit(12)).alias("month"),
        *[base[c].alias(f"b_{c}") for c in S.MEASURES], *[f"u{i + 1}" for i in range(DRAWS)],
    )
    b = {c: F.col(f"b_{c}") for c in S.MEASURES}
    flights, delayed = F.col("arr_flights"), F.col("arr_del15")

    def base_rate(c, den):
        return F.when(b[den] > 0, F.try_divide(b[c], b[den])).otherwise(F.lit(0.0))

    out = out.withColumn("arr_flights", F.greatest(F.lit(1), _whole(scaled(b["arr_flights"], 1, small))))
    rate = scaled(base_rate("arr_del15", "arr_flights") * F.lit(DELAY_RATE_CALIBRATION), 2, small)
    out = out.withColumn("arr_del15", F.greatest(F.lit(0), F.least(flights, _whole(
        flights * clamp(rate, F.lit(0.0), F.lit(MAX_DELAY_RATE))))))

    some = delayed > 0
    per_delayed = base_rate("arr_delay", "arr_del15")
    minutes_each = F.when(per_delayed <= 0, F.lit(DEFAULT_MINUTES_PER_DELAYED)).otherwise(per_delayed)
    base_minutes = _add([b[c] for c in S.CAUSE_MINUTES])
    out = out.withColumns({
        "arr_delay": F.when(some, F.greatest(F.lit(0), _whole(delayed * scaled(minutes_each, 3, wide))))
        .otherwise(F.lit(0)),
        "b_minutes": base_minutes,
    })
    out = out.withColumns({
        f"j{i}": F.greatest(F.lit(0.0), scaled(
            F.when(F.col("b_minutes") <= 0, F.lit(share)).otherwise(F.try_divide(b[c], F.col("b_minutes"))),
            4 + i, small))
        for i, (c, share) in enumerate(zip(S.CAUSE_MINUTES, DEFAULT_SHARES))
    })
    jitters = [F.col(f"j{i}") for i in range(len(S.CAUSES))]
    out = out.withColumn("j_total", _add(jitters))
    fallback = F.col("j_total") <= 0
    out = out.withColumns({
        f"part{i}": _whole(F.col("arr_delay") * F.when(fallback, F.lit(share / sum(DEFAULT_SHARES)))
                           .otherwise(F.try_divide(jitters[i], F.col("j_total"))))
        for i, share in enumerate(DEFAULT_SHARES)
    })
    parts = apportion([F.col(f"part{i}") for i in range(len(S.CAUSES))], F.col("arr_delay"))
    out = out.withColumns({c: F.when(some, p).otherwise(F.lit(0)) for c, p in zip(S.CAUSE_MINUTES, parts)})
    out = out.withColumns({
        c: F.when(some, clamp(scaled(delayed * base_rate(c, "arr_del15"), 9 + i, wide),
                              F.lit(0.0), delayed.cast("double"))).otherwise(F.lit(0.0))
        for i, c in enumerate(S.CAUSE_COUNTS)
    })
    cancel = clamp(scaled(base_rate("arr_cancelled", "arr_flights"), 14, small), F.lit(0.0), F.lit(MAX_CANCEL_RATE))
    divert = clamp(scaled(base_rate("arr_diverted", "arr_flights") * F.lit(DIVERT_RATE_CALIBRATION), 15, small),
                   F.lit(0.0), F.lit(MAX_DIVERT_RATE))
    out = out.withColumns({
        "arr_cancelled": _whole(flights * cancel),
        "arr_diverted": _whole(flights * divert),
        "year": F.lit(year),
    })
    names = [*S.PERIOD, *S.TEXT_COLUMNS, "arr_flights", "arr_del15", *S.CAUSE_COUNTS,
             "arr_cancelled", "arr_diverted", "arr_delay", *S.CAUSE_MINUTES]
    observations = computed_once(out, ["template_id", "replica"], {c: F.col(c) for c in names})
    return with_envelope(observations, seed) if envelope else observations


def with_envelope(observations, seed=42):
    """Add message fields. Ids depend on seed, template and replica, so a retried task repeats them."""
    now = F.current_timestamp()
    millis = F.unix_millis(now)

    def text_id(purpose):
        return F.md5(F.concat_ws(":", F.lit(f"{seed}-{purpose}"), F.col("template_id").cast("string"),
                                 F.col("replica").cast("string")))

    return observations.withColumns({
        "id": F.concat_ws("_", text_id("id"), millis.cast("string")),
        "message_id": text_id("message"),
        "kafka_key": F.concat_ws("_", "airport", "carrier", millis.cast("string")),
        "processing_timestamp": F.date_format(now, "yyyy-MM-dd HH:mm:ss.000"),
        "sequence_number": millis,
    })

"""The SQL twin of every registered query, written against the driver tables alone."""

MEASURES = [
    "arr_flights", "arr_del15", "arr_cancelled", "arr_diverted", "arr_delay",
    "carrier_ct", "weather_ct", "nas_ct", "security_ct", "late_aircraft_ct",
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
]
COUNTS = MEASURES[:4]
CTS = MEASURES[5:10]
DELAYS = MEASURES[10:]
KEYS = ["year", "month", "carrier", "airport"]
TEXT = ["carrier", "carrier_name", "airport", "airport_name"]
REQUIRED = ["year", "month"] + TEXT + MEASURES
WIRE = (["id", "year", "month"] + TEXT + ["arr_flights", "arr_del15"] + CTS
        + ["arr_cancelled", "arr_diverted", "arr_delay"] + DELAYS)


def _join(items, sep=", "):
    return sep.join(items)


def _cols(names, prefix=""):
    return _join([prefix + n for n in names])


def _q(condition):
    return f"cast(coalesce(sum(CASE WHEN {condition} THEN l_quantity END), 0) AS BIGINT)"


def _m(condition):
    return f"cast(coalesce(sum(CASE WHEN {condition} THEN l_quantity * l_linenumber END), 0) AS BIGINT)"


_R = "l_returnflag = 'R'"
CELLS = f"""
cells AS (
  SELECT cast(year(l_shipdate) AS BIGINT) AS year, cast(month(l_shipdate) AS BIGINT) AS month,
    c_mktsegment AS carrier, n_name AS airport,
    cast(sum(l_quantity) AS BIGINT) AS arr_flights,
    {_q(_R)} AS arr_del15,
    {_q("l_returnflag = 'A' AND l_linenumber = 1")} AS arr_cancelled,
    {_q("l_returnflag = 'A' AND l_linenumber = 2")} AS arr_diverted,
    {_q(_R + " AND l_linenumber = 1")} AS carrier_ct,
    {_q(_R + " AND l_linenumber = 2")} AS weather_ct,
    {_q(_R + " AND l_linenumber = 3")} AS nas_ct,
    {_q(_R + " AND l_linenumber = 4")} AS security_ct,
    {_q(_R + " AND l_linenumber >= 5")} AS late_aircraft_ct,
    {_m(_R + " AND l_linenumber = 1")} AS carrier_delay,
    {_m(_R + " AND l_linenumber = 2")} AS weather_delay,
    {_m(_R + " AND l_linenumber = 3")} AS nas_delay,
    {_m(_R + " AND l_linenumber = 4")} AS security_delay,
    {_m(_R + " AND l_linenumber >= 5")} AS late_aircraft_delay
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL
), obs AS (
  SELECT year, month, carrier,
    carrier || CASE WHEN (year * 12 + month + length(airport)) % 5 = 0 THEN ' Lines Inc.' ELSE ' Lines' END AS carrier_name,
    airport,
    airport || CASE WHEN (year * 12 + month) % 7 = 0 THEN ', International' ELSE ', Intl' END AS airport_name,
    arr_flights, arr_del15, arr_cancelled, arr_diverted,
    carrier_delay + weather_delay + nas_delay + security_delay + late_aircraft_delay AS arr_delay,
    {_cols(CTS)}, {_cols(DELAYS)}
  FROM cells
)"""


def _defect(cases, otherwise):
    whens = " ".join(f"WHEN k = {k} THEN {v}" for k, v in cases)
    return f"CASE {whens} ELSE {otherwise} END"


_GEN = "year = 2001"
_DIRTY_COLUMNS = {
    "year": _defect([(19, "NULL")], "year"),
    "month": _defect([(6, "13")], "month"),
    "carrier": f"CASE WHEN {_GEN} AND k = 22 THEN 'UNHEARD' WHEN k = 10 THEN NULL ELSE carrier END",
    "carrier_name": _defect([(1, "NULL")], "carrier_name"),
    "airport": f"CASE WHEN {_GEN} AND k IN (20, 21) THEN 'NEW_' || month WHEN k = 13 THEN NULL ELSE airport END",
    "airport_name": "airport_name",
    "arr_flights": _defect([(2, "-arr_flights"), (14, "6000000"), (15, "0")], "arr_flights"),
    "arr_del15": _defect([(3, "arr_flights + 3"), (16, "NULL")], "arr_del15"),
    "arr_cancelled": _defect([(9, "NULL")], "arr_cancelled"),
    "arr_diverted": _defect([(12, "NULL")], "arr_diverted"),
    "arr_delay": _defect([(5, "arr_delay + 5"), (7, "100500")], "arr_delay"),
    "nas_ct": _defect([(4, "arr_del15 + 1.5")], "nas_ct"),
    "security_ct": _defect([(17, "NULL")], "security_ct"),
    "late_aircraft_ct": _defect([(18, "arr_del15 + 2")], "late_aircraft_ct"),
    "weather_delay": _defect([(8, "-2")], "weather_delay"),
}
DIRTY = CELLS + f""", keyed AS (
  SELECT *, (year * 31 + month * 17 + arr_flights * 7) % 101 AS k FROM obs
), dirty AS (
  SELECT {_join([
      (f"cast({_DIRTY_COLUMNS.get(c, c)} AS DOUBLE)" if c in MEASURES else
       f"cast({_DIRTY_COLUMNS.get(c, c)} AS BIGINT)" if c in ("year", "month") else _DIRTY_COLUMNS.get(c, c))
      + f" AS {c}" for c in REQUIRED])}, {_GEN} AS is_generated
  FROM keyed
), d_original AS (SELECT * EXCLUDE (is_generated) FROM dirty WHERE NOT is_generated
), d_generated AS (SELECT * EXCLUDE (is_generated) FROM dirty WHERE is_generated
), d_cleaned AS (
  SELECT {_cols(["year", "month"] + TEXT)}, {_join([f"greatest(coalesce({c}, 0), 0) AS {c}" for c in MEASURES])}
  FROM d_original
)"""

_VALID = _join([
    "coalesce(arr_flights, 0) > 0", "coalesce(arr_del15, 0) <= coalesce(arr_flights, 0)",
    "coalesce(arr_delay, 0) >= 0", "coalesce(arr_delay, 0) < 100000",
    *[f"coalesce({c}, 0) >= 0" for c in DELAYS],
    *[f"coalesce({c}, 0) BETWEEN 0 AND coalesce(arr_del15, 0)" for c in CTS]], " AND ")

EV = """
ev AS (
  SELECT event_id, ts AS arrival, 'ev-' || event_id AS id,
    cast(year(ts) AS BIGINT) AS year, cast(month(ts) AS BIGINT) AS month,
    event_type AS carrier, event_type || ', Line' AS carrier_name,
    'U' || user_id AS airport, 'User: ' || user_id AS airport_name,
    cast(floor(value) AS BIGINT) + 1 AS arr_flights,
    cast(floor((cast(floor(value) AS BIGINT) + 1) / 4) AS BIGINT) AS arr_del15,
    event_id % 3 AS arr_cancelled, event_id % 2 AS arr_diverted
  FROM events
), evobs AS (
  SELECT *, arr_del15 * 0.5::DOUBLE AS carrier_ct, arr_del15 * 0.125::DOUBLE AS weather_ct,
    arr_del15 * 0.25::DOUBLE AS nas_ct, 0.0::DOUBLE AS security_ct, arr_del15 * 0.125::DOUBLE AS late_aircraft_ct,
    arr_del15 * 25 + arr_diverted AS arr_delay, arr_del15 * 10 AS carrier_delay, arr_del15 * 2 AS weather_delay,
    arr_del15 * 5 AS nas_delay, arr_diverted AS security_delay, arr_del15 * 8 AS late_aircraft_delay
  FROM ev
)"""

# Message shape by event_id % 12: 0 tokens, 1 array of one, 2 broken, 3 text values, 4 scalar, 5 array of two,
# 6 mixed array, 7 no id, 8 infinite, 9 object, 10 trailing text, 11 repeated key.
_NO_ID = (
    "sha256(year || chr(1) || '300' || chr(1) || carrier || chr(1) || airport)")
ACCEPTED = EV + f""", accepted AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 12 = 7 THEN {_NO_ID} ELSE id END AS id,
    CASE WHEN event_id % 12 = 7 THEN 255 ELSE month END AS month,
    CASE WHEN event_id % 12 = 7 THEN 0 ELSE arr_cancelled END AS arr_cancelled),
    date_trunc('second', arrival) AS ingestion_timestamp
  FROM evobs WHERE event_id % 12 IN (0, 3, 7, 9, 11)
)"""


def _ratio(n, d, alias):
    return f"round(CASE WHEN {d} > 0 THEN {n}::DOUBLE / {d} ELSE 0 END, 6) AS {alias}"


def _null_ratio(n, d, alias):
    return f"round({n}::DOUBLE / nullif({d}, 0), 6) AS {alias}"


_DELAY_SUM = _join([f"coalesce(sum({c}), 0)" for c in DELAYS], " + ")
OVERALL = [
    "total_flights", "total_delayed", "delay_rate", "cancel_rate", "divert_rate", "avg_delay_per_flight",
    "avg_delay_per_delayed", "unique_airports", "unique_carriers"] + [f"share_{c}" for c in DELAYS]


def _overall(source, digits=6):
    def ratio(n, d):
        return f"CASE WHEN sum({d}) > 0 THEN sum({n})::DOUBLE / sum({d}) ELSE 0 END"
    raw = {
        "total_flights": "coalesce(sum(arr_flights), 0)::DOUBLE",
        "total_delayed": "coalesce(sum(arr_del15), 0)::DOUBLE",
        "delay_rate": ratio("arr_del15", "arr_flights"),
        "cancel_rate": ratio("arr_cancelled", "arr_flights"),
        "divert_rate": ratio("arr_diverted", "arr_flights"),
        "avg_delay_per_flight": ratio("arr_delay", "arr_flights"),
        "avg_delay_per_delayed": ratio("arr_delay", "arr_del15"),
        "unique_airports": "count(DISTINCT airport)::DOUBLE",
        "unique_carriers": "count(DISTINCT carrier)::DOUBLE",
        **{f"share_{c}": f"CASE WHEN {_DELAY_SUM} > 0 THEN coalesce(sum({c}), 0)::DOUBLE / ({_DELAY_SUM}) END"
           for c in DELAYS},
    }
    shown = {n: (f"round({e}, {digits})" if digits else e) for n, e in raw.items()}
    return f"SELECT {_join([f'{e} AS {n}' for n, e in shown.items()])} FROM {source}"


_BY_MONTH_SUMS = COUNTS + ["arr_delay"] + DELAYS
_BY_MONTH = f"""
  SELECT month, {_join([f"cast(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in _BY_MONTH_SUMS])},
    {_null_ratio("sum(arr_del15)", "sum(arr_flights)", "delay_rate")},
    {_null_ratio("sum(arr_cancelled)", "sum(arr_flights)", "cancel_rate")},
    {_null_ratio("sum(arr_diverted)", "sum(arr_flights)", "divert_rate")},
    {_null_ratio("sum(arr_delay)", "sum(arr_flights)", "avg_delay_per_flight")},
    {_join([_null_ratio(f"sum({c})", _DELAY_SUM, f"share_{c}") for c in DELAYS])}
  FROM {{source}} WHERE month IS NOT NULL GROUP BY month"""

_SPINE = "(SELECT range AS month FROM range(1, 13))"


def _index(source, name):
    return f"""{name}_rates AS (
  SELECT year, month, sum(arr_flights) AS flights, sum(arr_del15)::DOUBLE / nullif(sum(arr_flights), 0) AS rate
  FROM {source} GROUP BY year, month
), {name}_indexed AS (
  SELECT *, rate / nullif(avg(rate) OVER (PARTITION BY year), 0) AS idx FROM {name}_rates
), {name} AS (
  SELECT s.month, v.seasonal_index FROM {_SPINE} s LEFT JOIN (
    SELECT month, sum(idx * flights) / sum(flights) AS seasonal_index FROM {name}_indexed
    WHERE idx IS NOT NULL AND flights > 0 GROUP BY month) v USING (month)
)"""


def _percent(n, d, alias):
    return f"round_even({n} * 100.0::DOUBLE / nullif({d}, 0), 2) AS {alias}"


def _top(code, where):
    return f"""WITH {CELLS}
SELECT {code}, min({code}_name) AS {code}_name, cast(sum(arr_flights) AS BIGINT) AS total_flights,
  cast(sum(arr_del15) AS BIGINT) AS delayed_flights, {_percent("sum(arr_del15)", "sum(arr_flights)", "delay_percentage")}
FROM obs WHERE {where} GROUP BY {code} ORDER BY delay_percentage DESC NULLS LAST, {code} LIMIT 10"""


_SUMMARY = {
    "total_flights": "arr_flights", "total_delayed": "arr_del15", "total_cancelled": "arr_cancelled",
    "total_diverted": "arr_diverted", "total_delay_minutes": "arr_delay", **{f"total_{c}": c for c in DELAYS}}


def _summary(source):
    sums = _join([f"cast(sum({c}) AS BIGINT) AS {n}" for n, c in _SUMMARY.items()])
    return f"SELECT {_cols(KEYS)}, {sums} FROM {source} GROUP BY {_cols(KEYS)}"


def _performance(code):
    return f"""WITH {CELLS}
SELECT year, month, {code}, {code}_name, cast(sum(arr_flights) AS BIGINT) AS total_flights,
  cast(sum(arr_del15) AS BIGINT) AS delayed_flights,
  {_percent("sum(arr_del15)", "sum(arr_flights)", "delay_percentage")},
  round_even(sum(arr_delay)::DOUBLE / nullif(sum(arr_flights), 0), 2) AS avg_delay_minutes
FROM obs GROUP BY year, month, {code}, {code}_name"""


def _minutes(source, arrival):
    return f"""minute_parts AS (
  SELECT date_trunc('minute', {arrival}) AS ingestion_minute, count(*) AS record_count,
    cast(sum(arr_flights) AS BIGINT) AS total_flights, cast(sum(arr_del15) AS BIGINT) AS total_delayed,
    coalesce(sum(arr_delay::DOUBLE / nullif(arr_flights, 0)), 0) AS ratio_sum,
    count(arr_delay::DOUBLE / nullif(arr_flights, 0)) AS ratio_count
  FROM {source} GROUP BY ALL)"""


_MINUTE_STATS = """SELECT ingestion_minute, record_count, total_flights, total_delayed,
  round(ratio_sum / nullif(ratio_count, 0), 6) AS avg_delay_per_flight FROM minute_parts"""


def _canonical(source, code):
    return f"""SELECT {code}, {code}_name FROM (
  SELECT {code}, {code}_name, row_number() OVER (PARTITION BY {code} ORDER BY count(*) DESC, {code}_name) AS r
  FROM {source} WHERE {code} <> '' AND {code}_name <> '' GROUP BY {code}, {code}_name) WHERE r = 1"""


DIMS = DIRTY + f""", dim_carrier AS ({_canonical("d_original", "carrier")}
), dim_airport AS ({_canonical("d_original", "airport")}
), expected AS (
  SELECT g.*, c.carrier_name AS carrier_expected, a.airport_name AS airport_expected
  FROM d_generated g LEFT JOIN dim_carrier c ON g.carrier = c.carrier LEFT JOIN dim_airport a ON g.airport = a.airport
), wrong AS (
  SELECT 'carrier' AS domain, carrier AS code, carrier_name AS label, carrier_expected AS expected
  FROM expected WHERE carrier_name <> carrier_expected
  UNION ALL SELECT 'airport', airport, airport_name, airport_expected FROM expected WHERE airport_name <> airport_expected
)"""

_RULES = [
    ("invalid_month", "have invalid month", "month < 1 OR month > 12", "error"),
    ("no_flights", "have arr_flights <= 0", "arr_flights <= 0", "warning"),
    ("delayed_over_flights", "have arr_del15 > arr_flights", "arr_del15 > arr_flights", "warning"),
    *[(f"negative_{c}", f"have negative {c}", f"{c} < 0", "warning") for c in MEASURES[1:]],
    ("delay_too_big", "have arr_delay > 100000", "arr_delay > 100000", "always"),
    ("flights_too_big", "have arr_flights > 5000000", "arr_flights > 5000000", "always"),
    *[(f"{c}_over_delayed", f"have {c} > arr_del15", f"{c} > arr_del15", "warning") for c in CTS],
    ("delay_sum_mismatch", "have delay sum mismatch > 1 minute",
     f"abs(arr_delay - ({_join([f'coalesce({c}, 0)' for c in DELAYS], ' + ')})) > 1", "warning"),
]


def _findings(source, dataset):
    parts = []
    for rule, wording, broken, kind in _RULES:
        severity = {"error": "error", "always": "warning"}.get(
            kind, "warning" if dataset == "ORIGINAL" else "error")
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{severity}' AS severity, '{rule}' AS rule, n, "
            f"'{dataset}: ' || n || ' records {wording}' AS message "
            f"FROM (SELECT count(*) AS n FROM {source} WHERE {broken}) WHERE n > 0")
    nulls = _join([f"count(*) FILTER ({c} IS NULL)" for c in REQUIRED], " + ")
    shown = _join([
        f"CASE WHEN count(*) FILTER ({c} IS NULL) > 0 THEN '''{c}'': ' || count(*) FILTER ({c} IS NULL) END"
        for c in REQUIRED])
    severity = "warning" if dataset == "ORIGINAL" else "error"
    parts.append(
        f"SELECT '{dataset}', '{severity}', 'missing_values', n, "
        f"'{dataset}: Nulls in required columns: {{' || shown || '}}' "
        f"FROM (SELECT {nulls} AS n, concat_ws(', ', {shown}) AS shown FROM {source}) WHERE n > 0")
    if dataset == "GENERATED":
        parts.append(
            f"SELECT 'GENERATED', 'warning', 'unexpected_years', len(ys)::BIGINT, 'GENERATED: unexpected year values [' "
            f"|| array_to_string(ys, ', ') || '] (expected only 2025)' FROM (SELECT list_sort(list(DISTINCT year) "
            f"FILTER (year IS NOT NULL)) AS ys FROM {source}) WHERE ys <> [2025]")
    return _join(parts, "\nUNION ALL ")


def _outcome_counts(o, g, dim_source):
    """Error and warning counts of a validation run, in the order of its checks."""
    return f"""found AS ({_findings(g, "GENERATED")}
), unknown AS (
  SELECT 'airport' AS domain FROM {g} WHERE airport IS NOT NULL AND airport NOT IN (SELECT airport FROM {o} WHERE airport IS NOT NULL)
  UNION SELECT 'carrier' FROM {g} WHERE carrier IS NOT NULL AND carrier NOT IN (SELECT carrier FROM {o} WHERE carrier IS NOT NULL)
), noisy AS (
  SELECT DISTINCT domain FROM (
    SELECT 'airport' AS domain, airport AS code FROM {g} WHERE airport_name IS NOT NULL AND airport IS NOT NULL
    GROUP BY airport HAVING count(DISTINCT airport_name) > 1
    UNION ALL SELECT 'carrier', carrier FROM {g} WHERE carrier_name IS NOT NULL AND carrier IS NOT NULL
    GROUP BY carrier HAVING count(DISTINCT carrier_name) > 1)
), named AS (
  SELECT 'carrier' AS domain FROM {g} g JOIN ({_canonical(dim_source, "carrier")}) c ON g.carrier = c.carrier
    WHERE g.carrier_name <> c.carrier_name
  UNION SELECT 'airport' FROM {g} g JOIN ({_canonical(dim_source, "airport")}) a ON g.airport = a.airport
    WHERE g.airport_name <> a.airport_name
), ok_o AS (SELECT * FROM {o} WHERE {_VALID}), ok_g AS (SELECT * FROM {g} WHERE {_VALID}
), k_o AS ({_overall("ok_o", None)}), k_g AS ({_overall("ok_g", None)}
), differs AS (
  SELECT (abs(g.delay_rate - o.delay_rate) > 0.02)::INT + (abs(g.cancel_rate - o.cancel_rate) > 0.01)::INT
    + (abs(g.divert_rate - o.divert_rate) > 0.005)::INT
    + (abs(g.avg_delay_per_flight - o.avg_delay_per_flight) > 2.0)::INT
    + (g.unique_airports < 50)::INT + (g.unique_carriers < 10)::INT AS n
  FROM k_o o, k_g g
), {_index("ok_o", "i_o")}, {_index("ok_g", "i_g")}, season AS (
  SELECT count(*) AS months, corr(o.seasonal_index, g.seasonal_index) AS r,
    avg(abs(o.seasonal_index - g.seasonal_index)) AS mad
  FROM i_o o JOIN i_g g USING (month) WHERE o.seasonal_index IS NOT NULL AND g.seasonal_index IS NOT NULL
), seasonal AS (
  SELECT CASE WHEN months < 10 THEN 1 ELSE (r < 0.70)::INT + (mad > 0.10)::INT END AS n FROM season
), tallied AS (
  SELECT (SELECT count(*) FROM found WHERE severity = 'error') + (SELECT count(*) FROM unknown) AS errors,
    (SELECT count(*) FROM found WHERE severity = 'warning') + (SELECT count(*) FROM noisy)
    + (SELECT count(*) FROM named) + (SELECT n FROM differs) + (SELECT n FROM seasonal) AS warnings
)"""


_STATUS = """SELECT '{run}' AS run, CASE WHEN errors > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'PASS_WITH_WARNINGS'
  ELSE 'PASS' END AS status, cast(errors AS BIGINT) AS errors, cast(warnings AS BIGINT) AS warnings FROM tallied"""


def _digest(seed):
    shown = _join([f"coalesce(cast({c} AS VARCHAR), chr(0))" for c in REQUIRED], " || chr(1) || ")
    return f"md5('{seed}' || chr(1) || {shown})"


def _u(draw):
    block, slot = divmod(draw - 1, 4)
    key = "event_id || ':' || replica"
    return (f"(cast('0x' || substr(md5('7:' || {key} || ':{block}'), {8 * slot + 1}, 8) AS BIGINT)::DOUBLE"
            " / 4294967296.0::DOUBLE)")


def _small(draw):
    return f"(0.9::DOUBLE + 0.2::DOUBLE * {_u(draw)})"


def _wide(draw):
    return f"(0.85::DOUBLE + 0.3::DOUBLE * {_u(draw)})"


_SHARES = [0.30, 0.06, 0.26, 0.002, 0.378]


def _scenario(replicas, columns):
    def rate(c, d):
        return f"(CASE WHEN b_{d} > 0 THEN b_{c} / b_{d} ELSE 0.0::DOUBLE END)"
    base = _join([f"{c}::DOUBLE AS b_{c}" for c in MEASURES])
    jit = _join([
        f"greatest(0.0::DOUBLE, (CASE WHEN b_minutes <= 0 THEN {s}::DOUBLE ELSE b_{c} / b_minutes END) * {_small(4 + i)})"
        f" AS j{i}" for i, (c, s) in enumerate(zip(DELAYS, _SHARES))])
    parts = _join([
        f"cast(round(arr_delay * (CASE WHEN j_total <= 0 THEN {s / sum(_SHARES)!r}::DOUBLE ELSE j{i} / j_total END))"
        f" AS BIGINT) AS p{i}" for i, s in enumerate(_SHARES)])
    before = ["0", "p0", "p0 + p1", "p0 + p1 + p2", "p0 + p1 + p2 + p3"]
    fixed = _join([
        f"CASE WHEN arr_del15 > 0 THEN p{i} - least(p{i}, greatest(p0 + p1 + p2 + p3 + p4 - arr_delay - ({before[i]}), 0))"
        + (" + greatest(arr_delay - (p0 + p1 + p2 + p3 + p4), 0)" if i == 0 else "") + f" ELSE 0 END AS {c}"
        for i, c in enumerate(DELAYS)])
    cts = _join([
        f"round(CASE WHEN arr_del15 > 0 THEN least(greatest(arr_del15 * {rate(c, 'arr_del15')} * {_wide(9 + i)}, 0.0), "
        f"arr_del15::DOUBLE) ELSE 0 END, 6) AS {c}" for i, c in enumerate(CTS)])
    return f"""WITH {EV}, src AS (
  SELECT event_id, replica, {_cols(TEXT)}, least(greatest(month, 1), 12) AS month, {base}
  FROM evobs, (SELECT unnest(range(1, {replicas + 1})) AS replica)
), s1 AS (
  SELECT *, greatest(1, cast(round(b_arr_flights * {_small(1)}) AS BIGINT)) AS arr_flights,
    {_join([f"b_{c}" for c in DELAYS], " + ")} AS b_minutes FROM src
), s2 AS (
  SELECT *, greatest(0, least(arr_flights, cast(round(arr_flights * least(greatest(
    {rate("arr_del15", "arr_flights")} * 1.085::DOUBLE * {_small(2)}, 0.0), 0.95::DOUBLE)) AS BIGINT))) AS arr_del15 FROM s1
), s3 AS (
  SELECT *, CASE WHEN arr_del15 > 0 THEN greatest(0, cast(round(arr_del15 * ((CASE WHEN {rate("arr_delay", "arr_del15")} <= 0
    THEN 55.0::DOUBLE ELSE {rate("arr_delay", "arr_del15")} END) * {_wide(3)})) AS BIGINT)) ELSE 0 END AS arr_delay, {jit} FROM s2
), s4 AS (SELECT *, j0 + j1 + j2 + j3 + j4 AS j_total FROM s3
), s5 AS (SELECT *, {parts} FROM s4
), s6 AS (
  SELECT event_id AS template_id, replica, 2025 AS year, month, {_cols(TEXT)}, arr_flights, arr_del15, {cts},
    cast(round(arr_flights * least(greatest({rate("arr_cancelled", "arr_flights")} * {_small(14)}, 0.0), 0.2::DOUBLE))
      AS BIGINT) AS arr_cancelled,
    cast(round(arr_flights * least(greatest({rate("arr_diverted", "arr_flights")} * 1.19::DOUBLE * {_small(15)}, 0.0),
      0.05::DOUBLE)) AS BIGINT) AS arr_diverted,
    arr_delay, {fixed}
  FROM s5
)
SELECT {_join([f"cast({c} AS BIGINT) AS {c}" if c not in CTS + TEXT else c for c in columns])} FROM s6"""


_SPLIT = ", o AS (SELECT * FROM obs WHERE year < 2001), g AS (SELECT * FROM obs WHERE year = 2001)"
_DIRTY_ROWS = _join(REQUIRED)


def _typed(columns):
    return _join([f"cast({c} AS DOUBLE) AS {c}" if c in MEASURES else c for c in columns])


def _templates():
    rows = _join([f"cast({c} AS DOUBLE) AS {c}" if c in MEASURES else c for c in REQUIRED])
    fill, stratum = _digest("7-fill"), _digest("7-stratum")
    return f"""WITH {CELLS}, size AS (
  SELECT greatest(1, cast(round_even(count(*)::DOUBLE / count(DISTINCT year), 0) AS BIGINT)) AS target,
    count(DISTINCT airport) AS strata FROM obs
), firsts AS (
  SELECT *, row_number() OVER (ORDER BY h) AS template_id FROM (
    SELECT *, {stratum} AS h, row_number() OVER (PARTITION BY airport ORDER BY {stratum}) AS r FROM obs) WHERE r = 1
), filler AS (
  SELECT *, row_number() OVER (ORDER BY {fill}) AS pos FROM obs
)
SELECT {rows}, template_id FROM firsts
UNION ALL SELECT {rows}, pos + strata FROM filler, size WHERE pos <= target - strata"""


_COERCE = """WITH t AS (
  SELECT event_id, event_id % 8 AS slot, floor(value) AS w FROM events
), n AS (
  SELECT event_id, CASE slot WHEN 0 THEN w + 0.9::DOUBLE WHEN 1 THEN -w WHEN 3 THEN w * 1000 WHEN 4 THEN w * 1e12
    WHEN 6 THEN w * 10 END AS x FROM t
)
SELECT event_id, cast(trunc(least(greatest(coalesce(x, 0), 0), 4294967295)) AS BIGINT) AS as_uint32,
  cast(trunc(least(greatest(coalesce(x, 0), 0), 255)) AS BIGINT) AS as_uint8,
  round(greatest(coalesce(x, 0), 0)::DOUBLE, 6) AS as_float FROM n"""

_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
           "November", "December"]
_MONTH_NAME = "CASE month " + " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(_MONTHS)) \
    + " ELSE cast(month AS VARCHAR) END"
_SLICE = "year = 2000 AND month IN (1, 2, 3, 6, 11)"
_EV_COLUMNS = ["event_id", "arrival", "id"] + ["year", "month"] + TEXT + ["arr_flights", "arr_del15"] + CTS + [
    "arr_cancelled", "arr_diverted", "arr_delay"] + DELAYS

ALL = {
    "src_csv": f"WITH {DIRTY} SELECT {_DIRTY_ROWS} FROM dirty",
    "src_ndjson": f"""WITH {EV}, lines AS (
  SELECT event_id % 12 AS s, carrier, arr_flights FROM evobs WHERE event_id % 13 <> 0)
SELECT s IN (2, 10) AS bad, CASE WHEN s IN (3, 7, 8, 9, 11) THEN carrier END AS carrier, count(*) AS n,
  cast(sum(CASE WHEN s IN (3, 7, 8, 9, 11) THEN arr_flights END) AS BIGINT) AS arr_flights FROM lines GROUP BY ALL""",
    "stream_ingest": f"WITH {ACCEPTED} SELECT {_cols(WIRE)} FROM accepted",
    "sink_partitioned": f"WITH {CELLS} SELECT {_cols(REQUIRED)} FROM obs",
    "sink_csv": f"WITH {CELLS} {_canonical('obs', 'airport')}",
    "sink_ndjson": f"WITH {DIRTY} SELECT {_DIRTY_ROWS} FROM dirty",
    "encode_messages": f"""WITH {EV}
SELECT airport || '_' || carrier || '_' || (epoch_us(arrival) // 1000) AS key, {_cols(WIRE)} FROM evobs""",
    "ingest_strict": f"WITH {ACCEPTED} SELECT {_cols(WIRE)}, ingestion_timestamp FROM accepted",
    "ingest_tokens": f"""WITH {EV} SELECT event_id, CASE WHEN event_id % 12 <> 7 THEN id END AS id, carrier_name, airport_name,
  cast(arr_flights AS VARCHAR) AS arr_flights FROM evobs WHERE event_id % 12 IN (0, 3, 7, 8, 9, 11)""",
    "ingest_lenient": f"""WITH {EV}
SELECT event_id, CASE WHEN event_id % 12 = 7 THEN NULL ELSE id END AS id, carrier,
  cast(arr_flights AS VARCHAR) AS arr_flights
FROM evobs, (SELECT unnest([1, 2]) AS copy) WHERE event_id % 12 NOT IN (2, 4, 10) AND (copy = 1 OR event_id % 12 = 5)""",
    "coerce_numeric": _COERCE,
    "record_id": f"""WITH {CELLS} SELECT {_cols(KEYS)},
  sha256(year || chr(1) || month || chr(1) || carrier || chr(1) || airport) AS record_id FROM obs""",
    "ingest_quarantine": """SELECT event_id, CASE event_id % 12 WHEN 1 THEN 'no_tokens' WHEN 2 THEN 'invalid_json'
  WHEN 4 THEN 'not_an_object' WHEN 5 THEN 'no_tokens' WHEN 6 THEN 'no_tokens' WHEN 8 THEN 'non_finite'
  WHEN 10 THEN 'invalid_json' END AS reason FROM events WHERE event_id % 12 IN (1, 2, 4, 5, 6, 8, 10)""",
    "partition_key": f"WITH {CELLS} SELECT year * 100 + month AS partition_key, count(*) AS n FROM obs GROUP BY ALL",
    "normalize": f"WITH {DIRTY} SELECT {_DIRTY_ROWS} FROM dirty",
    "clean_reference": f"WITH {DIRTY} SELECT {_DIRTY_ROWS} FROM d_cleaned",
    "clean_notes": f"""WITH {DIRTY} SELECT
  cast({_join([f"count(*) FILTER ({c} IS NULL)" for c in MEASURES], " + ")} AS BIGINT) AS filled_cells,
  cast({_join([f"count(*) FILTER ({c} < 0)" for c in MEASURES], " + ")} AS BIGINT) AS clipped_cells FROM d_original""",
    "fill_missing_cols": f"""WITH {CELLS} SELECT * REPLACE (cast(0 AS BIGINT) AS security_ct,
  cast(0 AS BIGINT) AS arr_diverted) FROM obs""",
    "safe_ratio": f"""WITH {CELLS} SELECT {_cols(KEYS)}, {_ratio("arr_delay", "arr_del15", "zero_ratio")},
  {_null_ratio("arr_delay", "arr_del15", "null_ratio")} FROM obs""",
    "month_labels": f"""WITH {DIRTY} SELECT DISTINCT month, {_MONTH_NAME} AS month_name,
  lpad(cast(month AS VARCHAR), 2, '0') || ' - ' || {_MONTH_NAME} AS month_label FROM dirty WHERE month IS NOT NULL""",
    "cause_breakdown": f"WITH {CELLS} " + " UNION ALL ".join(
        f"SELECT '{t}' AS cause, coalesce(sum({c}), 0)::DOUBLE AS minutes FROM obs WHERE {_SLICE}"
        for t, c in zip(["Carrier", "Weather", "NAS", "Security", "Late Aircraft"], DELAYS)),
    "kpi_slice": f"""WITH {CELLS} SELECT {_ratio("sum(arr_del15)", "sum(arr_flights)", "delay_rate")},
  {_ratio("sum(arr_delay)", "sum(arr_flights)", "avg_delay_per_flight")},
  {_ratio("sum(arr_delay)", "sum(arr_del15)", "avg_delay_per_delayed")},
  {_ratio("sum(arr_cancelled)", "sum(arr_flights)", "cancel_rate")},
  {_ratio("sum(arr_diverted)", "sum(arr_flights)", "divert_rate")},
  coalesce(sum(arr_flights), 0)::DOUBLE AS flights FROM obs WHERE {_SLICE}""",
    "years_last5": f"WITH {CELLS} SELECT * FROM obs WHERE year >= (SELECT max(year) FROM obs) - 4",
    "years_range": f"WITH {CELLS} SELECT * FROM obs WHERE year BETWEEN 1997 AND 1999",
    "valid_records": f"WITH {DIRTY} SELECT {_DIRTY_ROWS} FROM dirty WHERE {_VALID}",
    "minute_stats_last_hour": f"""WITH {EV}, {_minutes("evobs", "arrival")} {_MINUTE_STATS}
WHERE ingestion_minute >= (SELECT max(ts) FROM events) - INTERVAL 60 MINUTE""",
    "kpi_month_spine": f"""WITH {CELLS}
SELECT * FROM {_SPINE} LEFT JOIN ({_BY_MONTH.format(source="obs")}) USING (month)""",
    "canonicalize": f"""WITH {DIMS} SELECT {_cols(["year", "month", "carrier"])},
  CASE WHEN carrier_name <> carrier_expected THEN carrier_expected ELSE carrier_name END AS carrier_name, airport,
  CASE WHEN airport_name <> airport_expected THEN airport_expected ELSE airport_name END AS airport_name,
  {_cols(MEASURES)} FROM expected""",
    "domain_unknown": f"""WITH {DIRTY}, unknown AS (
  SELECT DISTINCT 'airport' AS domain, airport AS code FROM d_generated WHERE airport IS NOT NULL
    AND airport NOT IN (SELECT airport FROM d_original WHERE airport IS NOT NULL)
  UNION ALL SELECT DISTINCT 'carrier', carrier FROM d_generated WHERE carrier IS NOT NULL
    AND carrier NOT IN (SELECT carrier FROM d_original WHERE carrier IS NOT NULL))
SELECT domain, count(*) AS n, array_to_string((list(code ORDER BY code))[1:10], ',') AS examples
FROM unknown GROUP BY domain""",
    "kpi_compare": f"""WITH {CELLS}{_SPLIT}, ko AS ({_overall("o", None)}), kg AS ({_overall("g", None)}),
vo AS (UNPIVOT ko ON {_cols(OVERALL)} INTO NAME metric VALUE v), vg AS (UNPIVOT kg ON {_cols(OVERALL)} INTO NAME metric VALUE v),
aligned AS (
  SELECT metric, coalesce(vo.v, 0) AS original, coalesce(vg.v, 0) AS generated FROM vo FULL JOIN vg USING (metric)),
judged AS (SELECT *, abs(generated - original) AS abs_diff,
  CASE metric WHEN 'delay_rate' THEN 0.02::DOUBLE WHEN 'cancel_rate' THEN 0.01 WHEN 'divert_rate' THEN 0.005
    WHEN 'avg_delay_per_flight' THEN 2.0 END AS tolerance,
  CASE metric WHEN 'unique_airports' THEN 50::DOUBLE WHEN 'unique_carriers' THEN 10 END AS least FROM aligned)
SELECT metric, round(original, 6) AS original, round(generated, 6) AS generated, round(abs_diff, 6) AS abs_diff,
  tolerance, least, coalesce(abs_diff > tolerance, false) OR coalesce(generated < least, false) AS warns FROM judged""",
    "seasonal_compare": f"""WITH {CELLS}{_SPLIT}, {_index("o", "i_o")}, {_index("g", "i_g")}, p AS (
  SELECT o.seasonal_index AS o, g.seasonal_index AS g FROM i_o o JOIN i_g g USING (month)
  WHERE o.seasonal_index IS NOT NULL AND g.seasonal_index IS NOT NULL
), t AS (SELECT count(*) AS n, max(abs(o)) AS mo, max(abs(g)) AS mg, corr(o, g) AS r, avg(abs(o - g)) AS mad FROM p)
SELECT n AS seasonality_months_compared,
  round(CASE WHEN n >= 10 AND mo > 0 AND mg > 0 THEN r END, 6) AS seasonality_corr,
  round(CASE WHEN n >= 10 AND mo > 0 AND mg > 0 THEN mad END, 6) AS seasonality_mad,
  CASE WHEN n < 10 THEN 'too_few_months' WHEN mo > 0 AND mg > 0 THEN 'compared' ELSE 'all_zero' END AS outcome FROM t""",
    "delay_rate_by_month": f"""WITH {CELLS}, m AS (
  SELECT month, cast(sum(arr_flights) AS BIGINT) AS flights, cast(sum(arr_del15) AS BIGINT) AS delayed
  FROM obs WHERE year = 2000 GROUP BY month)
SELECT month, flights, delayed, {_ratio("delayed", "flights", "delay_rate")}, {_MONTH_NAME} AS month_name FROM m""",
    "top_carriers": _top("carrier", _SLICE),
    "top_airports": _top("airport", "year = 2000"),
    "rollup_summary": f"WITH {CELLS} {_summary('obs')}",
    "rollup_carrier": _performance("carrier"),
    "rollup_airport": _performance("airport"),
    "rollup_incremental": f"WITH {CELLS} {_summary('obs')}",
    "minute_stats_partial": f"""WITH {EV}, {_minutes("evobs", "arrival")}
SELECT * REPLACE (round(ratio_sum, 6) AS ratio_sum) FROM minute_parts""",
    "minute_stats": f"WITH {EV}, {_minutes('evobs', 'arrival')} {_MINUTE_STATS}",
    "kpi_overall": f"WITH {DIRTY}, ok AS (SELECT * FROM dirty WHERE {_VALID}) {_overall('ok')}",
    "kpi_by_month": f"WITH {CELLS} {_BY_MONTH.format(source='obs')}",
    "dq_null_counts": f"WITH {DIRTY} SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n FROM dirty" for c in REQUIRED) + ") WHERE n > 0",
    "dq_violations": f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, count(*) FILTER ({b}) AS n FROM dirty" for r, _, b, _ in _RULES),
    "canonical_carrier": f"WITH {DIRTY} {_canonical('d_original', 'carrier')}",
    "canonical_airport": f"WITH {DIRTY} {_canonical('d_original', 'airport')}",
    "noisy_names": f"WITH {DIRTY} " + " UNION ALL ".join(
        f"SELECT '{c}' AS domain, {c} AS code, count(DISTINCT {c}_name) AS labels FROM d_generated "
        f"WHERE {c} IS NOT NULL AND {c}_name IS NOT NULL GROUP BY {c} HAVING count(DISTINCT {c}_name) > 1"
        for c in ("airport", "carrier")),
    "seasonal_index": f"""WITH {CELLS}, {_index("obs", "i")}
SELECT month, round(seasonal_index, 6) AS seasonal_index FROM i""",
    "month_mean_index": f"""WITH {CELLS}, m AS (
  SELECT month, sum(arr_del15)::DOUBLE / nullif(sum(arr_flights), 0) AS r FROM obs GROUP BY month
), s AS (SELECT month, r FROM {_SPINE} LEFT JOIN m USING (month))
SELECT month, round(r, 6) AS delay_rate, round(r / nullif(avg(r) OVER (), 0), 6) AS month_index FROM s""",
    "latest_per_key": """SELECT user_id, event_type, event_id, ts, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1""",
    "avg_rows_per_year": f"""WITH {CELLS}
SELECT greatest(1, cast(round_even(count(*)::DOUBLE / count(DISTINCT year), 0) AS BIGINT)) AS rows FROM obs""",
    "valid_counts": f"""WITH {DIRTY}
SELECT count(*) FILTER ({_VALID}) AS kept, count(*) FILTER (NOT ({_VALID})) AS dropped FROM dirty""",
    "slicer_values": f"""WITH {CELLS} SELECT DISTINCT year, month, {_MONTH_NAME} AS month_name,
  lpad(cast(month AS VARCHAR), 2, '0') || ' - ' || {_MONTH_NAME} AS month_label FROM obs""",
    "name_mismatch": f"WITH {DIMS} SELECT domain, count(*) AS n FROM wrong GROUP BY domain",
    "name_mismatch_examples": f"""WITH {DIMS}, counted AS (
  SELECT domain, code, label, expected, count(*) AS n FROM wrong GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY code, label) AS position FROM counted)
SELECT * FROM ranked WHERE position <= 8""",
    "canonicalize_notes": f"""WITH {DIMS} SELECT count(*) FILTER (domain = 'carrier') AS carrier_labels_changed,
  count(*) FILTER (domain = 'airport') AS airport_labels_changed FROM wrong""",
    "templates_stratified": _templates(),
    "live_latest": f"""WITH {EV} SELECT {_cols(_EV_COLUMNS)} FROM evobs ORDER BY arrival DESC, event_id DESC LIMIT 25""",
    "live_buffer": f"""WITH {EV} SELECT {_cols(_EV_COLUMNS)} FROM evobs ORDER BY arrival DESC, event_id DESC LIMIT 5000""",
    "live_status": """SELECT least(count(*), 5000) AS buffered, max(ts) AS last_arrival FROM events""",
    "stream_minute_stats": f"WITH {ACCEPTED}, {_minutes('accepted', 'ingestion_timestamp')} {_MINUTE_STATS}",
    "live_rate": "WITH a AS (SELECT max(ts) AS as_of FROM events) SELECT " + _join([
        f"round(count(*) FILTER (ts >= as_of - INTERVAL {w} MINUTE) / {w}.0::DOUBLE, 6) AS per_minute_{w}"
        for w in (1, 5, 600)]) + " FROM events, a",
    "stream_sliding_rate": """WITH w AS (
  SELECT date_trunc('minute', ts) - to_minutes(k) AS window_start FROM events, (SELECT unnest(range(0, 5)) AS k))
SELECT window_start, count(*) AS messages, round(count(*) / 5.0::DOUBLE, 6) AS per_minute FROM w GROUP BY window_start""",
    "stream_rollup": f"WITH {ACCEPTED} {_summary('accepted')}",
    "stream_live": f"""WITH {EV}
SELECT arrival AS received_at, CASE WHEN event_id % 12 = 7 THEN NULL ELSE id END AS id, carrier, airport
FROM evobs, (SELECT unnest([1, 2]) AS copy) WHERE event_id % 12 NOT IN (2, 4, 10) AND (copy = 1 OR event_id % 12 = 5)""",
    "live_quarantine": """SELECT event_id, CASE event_id % 12 WHEN 4 THEN 'not_an_object' ELSE 'invalid_json' END AS reason
FROM events WHERE event_id % 12 IN (2, 4, 10)""",
    "stream_scenario": _scenario(1, ["template_id", "year", "month"] + TEXT + MEASURES),
    "validation_status": f"""SELECT * FROM (WITH {CELLS}{_SPLIT}, {_outcome_counts("o", "g", "o")}
{_STATUS.format(run="clean")})
UNION ALL SELECT * FROM (WITH {DIRTY}, {_outcome_counts("d_cleaned", "d_generated", "d_cleaned")}
{_STATUS.format(run="dirty")})""",
    "dq_findings": f"""WITH {DIRTY} SELECT * FROM ({_findings("d_cleaned", "ORIGINAL")}
UNION ALL {_findings("d_generated", "GENERATED")})""",
    "uniform_draws": "SELECT event_id, " + _join([f"round({_u(i)}, 9) AS u{i}" for i in (1, 2, 4, 5, 15)])
                     + " FROM (SELECT event_id, 1 AS replica FROM events)",
    "scenario": _scenario(2, ["template_id", "replica", "year", "month"] + TEXT + MEASURES),
    "apportion": f"""WITH {EV}, t AS (
  SELECT *, greatest(0, arr_delay + event_id % 61 - 30) AS target FROM evobs
), x AS (SELECT *, greatest(arr_delay - target, 0) AS over, greatest(target - arr_delay, 0) AS under FROM t)
SELECT event_id, target, carrier_delay - least(carrier_delay, over) + under AS part0,
  greatest(weather_delay - greatest(over - carrier_delay, 0), 0) AS part1,
  greatest(nas_delay - greatest(over - carrier_delay - weather_delay, 0), 0) AS part2,
  greatest(security_delay - greatest(over - carrier_delay - weather_delay - nas_delay, 0), 0) AS part3,
  greatest(late_aircraft_delay - greatest(over - carrier_delay - weather_delay - nas_delay - security_delay, 0), 0) AS part4
FROM x""",
    "stream_rate_asof": "WITH a AS (SELECT DISTINCT date_trunc('hour', ts) + INTERVAL 1 HOUR AS as_of FROM events) SELECT as_of, " + _join([
        f"round(count(*) FILTER (ts >= as_of - INTERVAL {w} MINUTE) / {w}.0::DOUBLE, 6) AS per_minute_{w}" for w in (1, 5, 600)])
        + " FROM a JOIN events ON ts < as_of AND ts >= as_of - INTERVAL 600 MINUTE GROUP BY as_of",
    "stream_mismatch": f"""WITH {DIRTY} SELECT * FROM (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS domain, {c} AS code, {c}_name AS label, d.{c}_name_c AS expected, count(*) AS n FROM d_original "
        f"JOIN (SELECT {c} AS k, {c}_name AS {c}_name_c FROM ({_canonical('d_original', c)})) d ON k = {c} "
        f"WHERE {c}_name <> {c}_name_c GROUP BY ALL" for c in ("airport", "carrier")) + ")",
}
ALL["stream_ingest_unique"] = ALL["stream_ingest"]
ALL["stream_latest"] = ALL["latest_per_key"]
ALL["kpi_overall_incremental"] = ALL["kpi_overall"]
ALL["stream_canonical"] = ALL["canonical_airport"]
ALL["templates_incremental"] = ALL["templates_stratified"]
ALL["stream_validation"] = ALL["validation_status"]
ALL["cube_kpi_slice"] = ALL["kpi_slice"]
ALL["cube_top_airports"] = ALL["top_airports"]
ALL["cube_top_carriers"] = ALL["top_carriers"]
ALL["cube_causes"] = ALL["cause_breakdown"]
ALL["cube_slicer_values"] = ALL["slicer_values"]
ALL["src_ndjson_all"] = f"""WITH {EV}
SELECT carrier, count(*) AS n, count(*) FILTER (event_id % 7 = 0) AS n_odd_name,
  count(*) FILTER (event_id % 3 = 0) AS n_message_id, count(*) FILTER (event_id % 5 = 0) AS n_sequence_number,
  cast(sum(event_id) FILTER (event_id % 5 = 0) AS BIGINT) AS sequence,
  max('{{"inner":' || event_id || '}}') FILTER (event_id % 7 = 0) AS odd, cast(sum(arr_flights) AS BIGINT) AS arr_flights,
  (SELECT count(*) FROM events WHERE event_id % 13 <> 0 AND event_id % 11 = 0) AS bad, cast(25 AS BIGINT) AS columns
FROM evobs WHERE event_id % 13 <> 0 AND event_id % 11 <> 0 GROUP BY carrier"""


_RULE_ORDER = {"missing_values": 1, "unexpected_years": 3, **{r[0]: 2 if i == 0 else i + 3 for i, r in enumerate(_RULES)}}
_ORDER = "CASE rule " + " ".join(f"WHEN '{r}' THEN {n}" for r, n in _RULE_ORDER.items()) + " END"
_TOLERANCES = [("delay_rate", "0.02"), ("cancel_rate", "0.01"), ("divert_rate", "0.005"), ("avg_delay_per_flight", "2.0")]


#: Rows without a period are in no group; a group without a delayed count has none.
_DATED = "(SELECT * REPLACE (coalesce(arr_del15, 0) AS arr_del15) FROM {} WHERE year IS NOT NULL AND month IS NOT NULL)"


def _line(section, stage, order, key="NULL", value="NULL", message="NULL"):
    return f"SELECT '{section}' AS section, {stage} AS stage, {order} AS ord, {key} AS key, {value} AS value, {message} AS message"


def _examples(code, table):
    """Number and first ten codes of a table of codes, as they are written in messages."""
    return f"""SELECT count(*) AS n, '[' || string_agg('''' || code || '''', ', ' ORDER BY code) FILTER (r <= 10) || ']' AS shown
  FROM (SELECT code, row_number() OVER (ORDER BY code) AS r FROM {table} WHERE domain = '{code}') HAVING count(*) > 0"""


def _report_lines(run, raw, o, g, year_note=""):
    """The report of a validation in long form: o is the cleaned reference, raw the reference before cleaning."""
    parts = [f"SELECT severity AS section, 1 AS stage, {_ORDER} AS ord, NULL AS key, NULL::DOUBLE AS value, message FROM gf",
             f"SELECT 'note', 2, {_ORDER}, NULL, NULL, message FROM of WHERE severity = 'warning'",
             f"SELECT 'reference_error', 1, {_ORDER}, NULL, NULL, message FROM of WHERE severity = 'error'"]
    for i, code in enumerate(("airport", "carrier")):
        parts.append(_line("error", 2, i, message=f"'GENERATED: ' || n || ' {code} codes not in original dataset (e.g. ' || shown || ')'")
                     + f" FROM ({_examples(code, 'unknown')})")
        parts.append(_line("warning", 2, i, message=f"'GENERATED: ' || n || ' {code}s have multiple {code}_name values (e.g. ' || shown || ')'")
                     + f" FROM ({_examples(code, 'noisy')})")
    for i, code in enumerate(("carrier", "airport")):
        shown = (f"'{{''{code}'': ''' || code || ''', ''{code}_name'': ''' || label || ''', "
                 f"''{code}_name_expected'': ''' || expected || '''}}'")
        parts.append(_line("warning", 3, i, message=(
            f"'GENERATED: ' || n || ' rows have {code}_name not matching canonical mapping (examples: [' || shown || '])'"))
            + f""" FROM (SELECT cast(sum(n) AS BIGINT) AS n, string_agg({shown}, ', ' ORDER BY r) FILTER (r <= 8) AS shown FROM (
  SELECT *, row_number() OVER (ORDER BY code, label) AS r FROM named WHERE domain = '{code}') HAVING count(*) > 0)""")
        parts.append(_line("canonicalization", 0, i, message=f"'Canonicalized {code}_name for ' || format('{{:,}}', n) || ' rows'")
                     + f" FROM (SELECT cast(sum(n) AS BIGINT) AS n FROM named WHERE domain = '{code}' HAVING count(*) > 0)")
    for i, (metric, limit) in enumerate(_TOLERANCES):
        parts.append(_line("warning", 4, i, message=(
            f"printf('KPI {metric}: generated=%.4f vs original=%.4f (abs diff=%.4f > {limit})', g.{metric}, o.{metric}, "
            f"abs(g.{metric} - o.{metric}))")) + f" FROM k_o o, k_g g WHERE abs(g.{metric} - o.{metric}) > {limit}")
    for i, (what, least) in enumerate((("airport", 50), ("carrier", 10))):
        parts.append(_line("warning", 4, 4 + i, message=f"'Low {what} coverage in generated: ' || cast(unique_{what}s AS BIGINT)")
                     + f" FROM k_g WHERE unique_{what}s < {least}")
    parts += [
        _line("warning", 5, 0, message="'Monthly seasonality check: only ' || months || "
              "'/12 months comparable; correlation may be unreliable'") + " FROM season WHERE months < 10",
        _line("warning", 5, 2, message="printf('Monthly delay_rate seasonal-index correlation is low: corr=%.2f "
              "(expected >= 0.70)', r)") + " FROM season WHERE months >= 10 AND r < 0.70",
        _line("warning", 5, 3, message="printf('Monthly delay_rate seasonal-index mean abs diff is high: %.3f "
              "(expected <= 0.10)', mad)") + " FROM season WHERE months >= 10 AND mad > 0.10",
        _line("seasonality", 0, 0, "'seasonality_months_compared'", "months::DOUBLE") + " FROM season",
        _line("seasonality", 0, 0, "'seasonality_corr'", "round(r, 6)") + " FROM season WHERE months >= 10 AND r IS NOT NULL",
        _line("seasonality", 0, 0, "'seasonality_mad'", "round(mad, 6)") + " FROM season WHERE months >= 10"]
    for section, table in (("original", "k_o"), ("generated", "k_g")):
        parts += [_line(section, 0, 0, f"'{m}'", f"round({m}, 6)") + f" FROM {table} WHERE {m} IS NOT NULL" for m in OVERALL]
    filled = _join([f"count(*) FILTER ({c} IS NULL)" for c in MEASURES], " + ")
    clipped = _join([f"count(*) FILTER ({c} < 0)" for c in MEASURES], " + ")
    for i, (before, after, cells) in enumerate((("Filled", "numeric nulls with 0", filled), ("Clipped", "negative numeric values to 0", clipped))):
        parts.append(_line("note", 1, i, message=f"'{before} ' || n || ' {after} in ORIGINAL'")
                     + f" FROM (SELECT {cells} AS n FROM {raw}) WHERE n > 0")
    if year_note:
        parts.append(_line("note", 0, 0, message=year_note) + f" FROM {o}")
    union = "\nUNION ALL ".join(parts)
    wrong = " UNION ALL ".join(
        f"""SELECT '{c}' AS domain, g.{c} AS code, g.{c}_name AS label, d.{c}_name AS expected, count(*) AS n
  FROM {g} g JOIN ({_canonical(o, c)}) d ON g.{c} = d.{c} WHERE g.{c}_name <> d.{c}_name GROUP BY ALL""" for c in ("carrier", "airport"))
    codes = " UNION ALL ".join(
        f"""SELECT DISTINCT '{c}' AS domain, {c} AS code FROM {g} WHERE {c} IS NOT NULL
  AND {c} NOT IN (SELECT {c} FROM {o} WHERE {c} IS NOT NULL)""" for c in ("airport", "carrier"))
    several = " UNION ALL ".join(
        f"""SELECT '{c}' AS domain, {c} AS code FROM {g} WHERE {c} IS NOT NULL AND {c}_name IS NOT NULL
  GROUP BY {c} HAVING count(DISTINCT {c}_name) > 1""" for c in ("airport", "carrier"))
    return f"""gf AS ({_findings(g, "GENERATED")}), of AS ({_findings(o, "ORIGINAL")}), unknown AS ({codes}), noisy AS ({several}),
named AS ({wrong}), ok_o AS (SELECT * FROM {o} WHERE {_VALID}), ok_g AS (SELECT * FROM {g} WHERE {_VALID}),
k_o AS ({_overall("ok_o", None)}), k_g AS ({_overall("ok_g", None)}),
{_index(_DATED.format("ok_o"), "i_o")}, {_index(_DATED.format("ok_g"), "i_g")}, season AS (
  SELECT count(*) AS months, corr(o.seasonal_index, g.seasonal_index) AS r, avg(abs(o.seasonal_index - g.seasonal_index)) AS mad
  FROM i_o o JOIN i_g g USING (month) WHERE o.seasonal_index IS NOT NULL AND g.seasonal_index IS NOT NULL)
SELECT '{run}' AS run, section, cast(stage AS BIGINT) AS stage, cast(ord AS BIGINT) AS ord, cast(key AS VARCHAR) AS key,
  cast(value AS DOUBLE) AS value, cast(message AS VARCHAR) AS message FROM ({union})"""


ALL["validation_lines"] = f"""SELECT * FROM (WITH {CELLS}, g AS (SELECT * FROM obs WHERE year = 2001),
  o AS (SELECT * FROM obs WHERE year < 2001 AND year >= (SELECT max(year) - 4 FROM obs WHERE year < 2001)),
{_report_lines("clean", "o", "o", "g", "'Filtered ORIGINAL to last 5 years: ' || (max(year) - 4) || '-' || max(year)")})
UNION ALL SELECT * FROM (WITH {DIRTY}, {_report_lines("dirty", "d_original", "d_cleaned", "d_generated")})"""
ALL["sink_report"] = f"""WITH {DIRTY}, {_outcome_counts("d_cleaned", "d_generated", "d_cleaned")}
SELECT CASE WHEN errors > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS status,
  cast(errors AS BIGINT) AS errors, cast(warnings AS BIGINT) AS warnings, errors > 0 AS stopped,
  (SELECT round(coalesce(sum(arr_flights), 0)::DOUBLE, 6) FROM ok_o) AS total_flights FROM tallied"""
ALL["decode_bytes"] = """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'é-' || event_id || '€' END AS strict,
  'é-' || event_id || CASE event_id % 3 WHEN 0 THEN chr(65533) WHEN 1 THEN chr(65533) || '(' ELSE '€' END AS lenient FROM events"""
ALL["ingest_clock"] = f"WITH {ACCEPTED} SELECT true AS now, true AS whole, count(*) AS n FROM accepted"

"""The SQL that each registered query is compared with, for DuckDB."""

from __future__ import annotations

from skyloom.catalog.queries import ENRICHED_WEIGHTS, FLIGHT_INTERCEPT, FLIGHT_WEIGHTS, SPLIT

# Shared building blocks, as common table expressions.

_RAW = """
raw AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

_FLIGHTS = (
    _RAW
    + """,
flights AS (
  SELECT event_id,
         date_trunc('minute', ts) AS timestamp,
         upper(left(event_type, 2)) || '//' || CAST(user_id AS VARCHAR) AS flight_number,
         CAST(10000 + user_id % 20 AS VARCHAR) AS origin_airport_id,
         k IN (3, 4) AS is_cancelled,
         round(value - 50, 2) AS departure_delay_minutes,
         round(value - 50 + (k - 50) / CAST(5 AS DOUBLE), 2) + CAST(0 AS DOUBLE) AS arrival_delay_minutes,
         CAST(k AS DOUBLE) AS taxi_out_minutes,
         round(value * 10) AS distance_miles
  FROM raw
  WHERE k NOT IN (0, 1, 2, 5)
)"""
)

_AIRPORTS = (
    _FLIGHTS
    + """,
airports AS (
  SELECT date_trunc('hour', f.timestamp) - to_hours(h.h) AS timestamp,
         f.origin_airport_id,
         avg(f.departure_delay_minutes) AS average_departure_delay
  FROM flights f, (SELECT unnest([0, 1, 2, 3]) AS h) h
  GROUP BY 1, 2
)"""
)

_PART1 = (
    _RAW
    + """,
rows AS (
  SELECT event_id,
         round(value - 50, 2) AS "DepDelay",
         CAST(k AS DOUBLE) AS "TaxiOut",
         CASE WHEN k <> 5 THEN round(value * 10) END AS "Distance",
         CASE WHEN k = 1 THEN false
              ELSE round(value - 50 + (k - 50) / CAST(5 AS DOUBLE), 2) > 15 END AS target,
         strftime(ts, '%Y-%m-%d') AS day
  FROM raw
  WHERE k NOT IN (3, 4)
)"""
)

_NEWEST_FLIGHTS = """
newest AS (
  SELECT * FROM flights
  QUALIFY row_number() OVER (PARTITION BY flight_number, timestamp ORDER BY event_id DESC) = 1
)"""

_FLIGHT_COLUMNS = """
  round(departure_delay_minutes, 8) AS departure_delay_minutes,
  round(arrival_delay_minutes, 8) AS arrival_delay_minutes,
  round(taxi_out_minutes, 8) AS taxi_out_minutes,
  round(distance_miles, 8) AS distance_miles"""


def _linear(weights: dict[str, float], intercept: float) -> str:
    terms = [f"CAST({intercept!r} AS DOUBLE)"]
    terms += [f"CAST({w!r} AS DOUBLE) * {name}" for name, w in weights.items()]
    return " + ".join(terms)


_SCORED = (
    _FLIGHTS
    + f""",
scored AS (
  SELECT event_id,
         arrival_delay_minutes > 15 AS target,
         round(1 / (1 + exp(-({_linear(FLIGHT_WEIGHTS, FLIGHT_INTERCEPT)}))), 6) AS score,
         1 / (1 + exp(-({_linear(FLIGHT_WEIGHTS, FLIGHT_INTERCEPT)}))) > 0.5 AS prediction
  FROM flights
)"""
)

_CONFUSION = """
SELECT a.actual,
       CAST(count(*) FILTER (s.target = a.flag AND NOT s.prediction) AS BIGINT) AS predicted_false,
       CAST(count(*) FILTER (s.target = a.flag AND s.prediction) AS BIGINT) AS predicted_true
FROM (VALUES ('False', false), ('True', true)) a(actual, flag) LEFT JOIN scored s ON true
GROUP BY a.actual"""


_CORNERS = """
SELECT round(fpr, 4) AS fpr, round(max(tpr), 4) AS tpr, round(min(threshold), 4) AS threshold
FROM points GROUP BY points.fpr"""


def _curve(source: str, thinned: bool, digits: int, after: str = "SELECT * FROM points") -> str:
    """The ROC curve of a CTE with ``target`` and ``score``, as a CTE ``points`` and what comes after it."""
    keep = "rank = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg"
    return f"""
steps AS (
  SELECT score, count(*) FILTER (target) AS pos, count(*) FILTER (NOT target) AS neg
  FROM {source} GROUP BY score
),
curve AS (
  SELECT score, pos, neg,
         sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
         row_number() OVER w AS rank, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
         sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM steps WINDOW w AS (ORDER BY score DESC)
),
points AS (
SELECT round(CAST(fps AS DOUBLE) / CAST(all_neg AS DOUBLE), {digits}) AS fpr,
       round(CAST(tps AS DOUBLE) / CAST(all_pos AS DOUBLE), {digits}) AS tpr,
       round(score, {digits}) AS threshold
FROM curve {"WHERE " + keep if thinned else ""}
UNION ALL
SELECT 0.0::DOUBLE, 0.0::DOUBLE, round(max(score) + 1, {digits}) FROM steps
)
{after}"""


def _roc(thinned: bool) -> str:
    return f"WITH {_SCORED},{_curve('scored', thinned, 9)}"


def _newton(source: str, names: list[str], steps: int = 16) -> str:
    """CTEs that fit a logistic regression with penalty |w|^2 / 2 by Newton's method.

    ``source`` is a CTE with the columns ``names`` and ``target``. Each step sums
    gradient and Hessian over all rows and eliminates the small system column by
    column. The last CTE, ``fit``, has the weights ``w0..``, intercept last.
    """
    size = len(names) + 1
    z = [f"z{i}" for i in range(size)]
    scaled = ", ".join(
        f"(coalesce(s.{n}, m{i}) - avg(coalesce(s.{n}, m{i})) OVER ())"
        f" / stddev_pop(coalesce(s.{n}, m{i})) OVER () AS z{i}"
        for i, n in enumerate(names)
    )
    medians = ", ".join(f"median({n}) AS m{i}" for i, n in enumerate(names))
    ctes = [
        f"middle AS MATERIALIZED (SELECT {medians} FROM {source})",
        f"x AS MATERIALIZED (SELECT {scaled}, CAST(1 AS DOUBLE) AS z{size - 1},"
        f" CAST(s.target AS DOUBLE) AS y FROM {source} s, middle)",
        "fit_0 AS MATERIALIZED (SELECT "
        + ", ".join(f"CAST(0 AS DOUBLE) AS w{i}" for i in range(size))
        + ")",
    ]
    for step in range(1, steps + 1):
        margin = " + ".join(f"w.w{i} * x.{z[i]}" for i in range(size))
        ctes.append(
            f"p_{step} AS MATERIALIZED (SELECT x.*, 1 / (1 + exp(-({margin}))) AS p"
            f" FROM x, fit_{step - 1} w)"
        )
        sums = []
        for i in range(size):
            for j in range(size):
                ridge = 1 if i == j and i < size - 1 else 0
                sums.append(f"sum(p * (1 - p) * {z[i]} * {z[j]}) + {ridge} AS a{i}_{j}")
            penalty = f" + max(w.w{i})" if i < size - 1 else ""
            sums.append(f"sum((p - y) * {z[i]}){penalty} AS a{i}_{size}")
        ctes.append(
            f"e_{step}_0 AS MATERIALIZED (SELECT {', '.join(sums)}"
            f" FROM p_{step}, fit_{step - 1} w)"
        )
        for k in range(size):
            cells = []
            for i in range(size):
                for j in range(size + 1):
                    pivot = f"a{k}_{j} / a{k}_{k}"
                    cell = pivot if i == k else f"a{i}_{j} - a{i}_{k} * {pivot}"
                    cells.append(f"{cell} AS a{i}_{j}")
            ctes.append(
                f"e_{step}_{k + 1} AS MATERIALIZED (SELECT {', '.join(cells)} FROM e_{step}_{k})"
            )
        moved = ", ".join(f"w.w{i} - e.a{i}_{size} AS w{i}" for i in range(size))
        ctes.append(
            f"fit_{step} AS MATERIALIZED (SELECT {moved} FROM fit_{step - 1} w,"
            f" e_{step}_{size} e)"
        )
    scales = ", ".join(
        f"avg(coalesce(s.{n}, m{i})) AS mean{i}, stddev_pop(coalesce(s.{n}, m{i})) AS std{i}"
        for i, n in enumerate(names)
    )
    ctes.append(f"scale AS MATERIALIZED (SELECT {scales} FROM {source} s, middle)")
    ctes.append(f"fit AS (SELECT * FROM fit_{steps})")
    return ",\n".join(ctes)


def _margin(names: list[str], row: str) -> str:
    """The margin of a row under ``fit``, ``scale`` and ``middle``."""
    terms = [
        f"fit.w{i} * (coalesce({row}.{n}, middle.m{i}) - scale.mean{i}) / scale.std{i}"
        for i, n in enumerate(names)
    ]
    return " + ".join([*terms, f"fit.w{len(names)}"])


_RAW_NAMES = ['"DepDelay"', '"TaxiOut"', '"Distance"']
_JOINED_NAMES = [
    "departure_delay_minutes",
    "taxi_out_minutes",
    "distance_miles",
    "average_departure_delay",
]

_RAW_FIT = (
    _PART1
    + f""",
train AS (SELECT * FROM rows WHERE day < '{SPLIT}'),
test AS (SELECT * FROM rows WHERE day >= '{SPLIT}'),
"""
    + _newton("train", _RAW_NAMES)
)

_SERVED = (
    _AIRPORTS
    + ","
    + _NEWEST_FLIGHTS
    + """,
served AS (
  SELECT f.event_id, f.timestamp, n.is_cancelled, n.departure_delay_minutes,
         n.arrival_delay_minutes, n.taxi_out_minutes, n.distance_miles,
         a.average_departure_delay
  FROM flights f
  LEFT JOIN newest n ON n.flight_number = f.flight_number AND n.timestamp = f.timestamp
  ASOF LEFT JOIN airports a
    ON a.origin_airport_id = f.origin_airport_id AND a.timestamp <= f.timestamp
),
joined AS (
  SELECT *, arrival_delay_minutes > 15 AS target FROM served WHERE NOT is_cancelled
)"""
)


def _fit_scored(names: list[str], rows: str) -> str:
    return f"""
scored AS (
  SELECT r.*, {_margin(names, "r")} > 0 AS prediction FROM {rows} r, fit, scale, middle
)"""


def _fitted_requests() -> str:
    """Every flight with the latest mean of its airport, scored by the model fitted to the training rows."""
    margin = _margin(_JOINED_NAMES, "r")
    return f"""
WITH {_SERVED},
train AS (SELECT * FROM joined WHERE timestamp < TIMESTAMP '{SPLIT}'),
{_newton("train", _JOINED_NAMES)},
latest AS (
  SELECT origin_airport_id, arg_max(average_departure_delay, timestamp) AS average_departure_delay
  FROM airports GROUP BY origin_airport_id
),
requests AS (
  SELECT f.*, l.average_departure_delay FROM flights f LEFT JOIN latest l USING (origin_airport_id)
)
SELECT event_id, round(r.average_departure_delay, 4) AS average_departure_delay,
       {margin} > 0 AS prediction, round(1 / (1 + exp(-({margin}))), 4) AS score
FROM requests r, fit, scale, middle"""


def _pit_airport(shift_hours: int) -> str:
    return f"""
WITH {_AIRPORTS},
stamped AS (
  SELECT timestamp + to_hours({shift_hours}) AS at, origin_airport_id, average_departure_delay
  FROM airports
)
SELECT f.event_id, f.flight_number AS flight, f.origin_airport_id AS airport, f.timestamp,
       round(s.average_departure_delay, 8) AS average_departure_delay
FROM flights f ASOF LEFT JOIN stamped s
  ON s.origin_airport_id = f.origin_airport_id AND s.at <= f.timestamp"""


_PIT_FLIGHT_SELECT = f"""
SELECT f.event_id, f.flight_number AS flight, f.origin_airport_id AS airport, f.timestamp,
       n.origin_airport_id, n.is_cancelled,
       {_FLIGHT_COLUMNS.replace("round(", "round(n.")}"""

_FLIGHT_SELECT = f"SELECT timestamp, flight_number, origin_airport_id, is_cancelled, {_FLIGHT_COLUMNS}"

_AIRPORT_SELECT = """
SELECT timestamp, origin_airport_id,
       round(average_departure_delay, 8) AS average_departure_delay"""

_ENRICHED = f"""
WITH {_AIRPORTS},
latest AS (
  SELECT origin_airport_id, arg_max(average_departure_delay, timestamp) AS average_departure_delay
  FROM airports GROUP BY origin_airport_id
),
found AS (
  SELECT f.*, l.average_departure_delay
  FROM flights f LEFT JOIN latest l USING (origin_airport_id)
),
probability AS (
  SELECT event_id, average_departure_delay,
         1 / (1 + exp(-({_linear(ENRICHED_WEIGHTS, FLIGHT_INTERCEPT)}))) AS p
  FROM found
)
SELECT event_id, round(average_departure_delay, 8) AS average_departure_delay,
       round(p, 8) AS score, p > 0.5 AS prediction
FROM probability"""

_AIRPORT_QUERY = f"WITH {_AIRPORTS} {_AIRPORT_SELECT} FROM airports"

_DATASET_COLUMNS = """
  round("DepDelay", 8) AS "DepDelay", round("TaxiOut", 8) AS "TaxiOut",
  round("Distance", 8) AS "Distance", target"""

ORACLES: dict[str, str] = {
    "raw_text_parse": f"""
WITH {_RAW}
SELECT event_id,
       CAST(year(ts) AS VARCHAR) AS "Year",
       strftime(ts, '%Y-%m-%d') AS "FlightDate",
       upper(left(event_type, 2)) AS "Reporting_Airline",
       'N"' || CAST(user_id AS VARCHAR) || '"' AS "Tail_Number",
       CAST(user_id AS VARCHAR) AS "Flight_Number_Reporting_Airline",
       CAST(10000 + user_id % 20 AS VARCHAR) AS "OriginAirportID",
       event_type || ', ' || CAST(user_id AS VARCHAR) AS "OriginCityName",
       CAST(round(value - 50, 2) AS VARCHAR) AS "DepDelay",
       CAST(k AS VARCHAR) AS "TaxiOut",
       CASE WHEN k = 2 THEN '2400' WHEN k <> 0 THEN strftime(ts, '%H%M') END AS "WheelsOff",
       CASE WHEN k <> 1
            THEN CAST(round(value - 50 + (k - 50) / CAST(5 AS DOUBLE), 2) + CAST(0 AS DOUBLE) AS VARCHAR)
            END AS "ArrDelay",
       CASE WHEN k = 3 THEN '1.00' ELSE '0.00' END AS "Cancelled",
       CASE WHEN k = 4 THEN '1.00' ELSE '0.00' END AS "Diverted",
       CASE WHEN k <> 5 THEN CAST(round(value * 10) AS VARCHAR) END AS "Distance",
       CAST(NULL AS VARCHAR) AS "Div5TailNum"
FROM raw""",
    "flights_clean": f"WITH {_FLIGHTS} {_FLIGHT_SELECT}, event_id FROM flights",
    "flights_rejects": f"""
WITH {_RAW}
SELECT event_id,
       upper(left(event_type, 2)) || '//' || CAST(user_id AS VARCHAR) AS flight_number,
       CASE k WHEN 0 THEN 'wheels_off_length' WHEN 1 THEN 'arrival_delay_minutes'
              WHEN 2 THEN 'time' ELSE 'no_distance' END AS reason
FROM raw WHERE k IN (0, 1, 2, 5)""",
    "read_instances": f"""
WITH {_FLIGHTS}
SELECT event_id, flight_number AS flight, origin_airport_id AS airport,
       strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS timestamp
FROM flights""",
    "zip_ingest": f"""
WITH {_FLIGHTS}
{_FLIGHT_SELECT}, CAST(year(timestamp) AS INTEGER) AS file_year,
       CAST(month(timestamp) AS INTEGER) AS file_month
FROM flights""",
    "flights_of_a_range": f"""
WITH {_FLIGHTS} {_FLIGHT_SELECT} FROM flights
WHERE timestamp >= TIMESTAMP '2024-01-09 17:30:00' AND timestamp < TIMESTAMP '2024-01-12'""",
    "text_scan": f"WITH {_FLIGHTS} {_FLIGHT_SELECT} FROM flights",
    "feature_roundtrip": f"WITH {_FLIGHTS} {_FLIGHT_SELECT} FROM flights",
    "feature_job": _AIRPORT_QUERY,
    "airport_sliding_mean_panes": _AIRPORT_QUERY,
    "airport_sliding_mean": _AIRPORT_QUERY,
    "airport_sliding_stream": _AIRPORT_QUERY,
    "feature_stream_job": _AIRPORT_QUERY,
    "feature_ingest_dedup": f"""
WITH {_FLIGHTS},
ingested AS (
  SELECT * FROM flights
  UNION ALL BY NAME
  SELECT * REPLACE (event_id + 1000000000000 AS event_id, 0.0 AS arrival_delay_minutes)
  FROM flights WHERE is_cancelled
),
kept AS (
  SELECT * FROM ingested
  QUALIFY row_number() OVER (PARTITION BY flight_number, timestamp ORDER BY event_id DESC) = 1
)
SELECT flight_number AS entity_id, timestamp AS feature_time, origin_airport_id, is_cancelled,
       {_FLIGHT_COLUMNS}
FROM kept""",
    "feature_ingest_subset": f"""
WITH {_FLIGHTS},
versions AS (
  SELECT *, event_id * 2 AS one, CASE WHEN NOT is_cancelled THEN -2 * event_id END AS two,
         event_id * 2 - 5001 AS three
  FROM flights
),
taxi AS (
  SELECT flight_number, timestamp, taxi_out_minutes AS taxi, two AS version FROM versions WHERE two IS NOT NULL
  UNION ALL SELECT flight_number, timestamp, taxi_out_minutes + 1, three FROM versions
),
taxis AS (
  SELECT flight_number, timestamp, arg_max(taxi, version) AS taxi FROM taxi GROUP BY ALL
),
merged AS (
  SELECT flight_number, timestamp, arg_max(origin_airport_id, one) AS origin_airport_id,
         arg_max(is_cancelled, one) AS is_cancelled,
         arg_max(departure_delay_minutes, one) AS departure_delay_minutes,
         arg_max(arrival_delay_minutes, two) FILTER (two IS NOT NULL) AS arrival_delay_minutes,
         arg_max(distance_miles, three) AS distance_miles
  FROM versions GROUP BY flight_number, timestamp
)
SELECT flight_number AS entity_id, timestamp AS feature_time, origin_airport_id, is_cancelled,
       {_FLIGHT_COLUMNS.replace("round(taxi_out_minutes, 8)", "round(taxi, 8)")}
FROM merged JOIN taxis USING (flight_number, timestamp)""",
    "pit_airport_window_start": _pit_airport(0),
    "pit_airport_window_end": _pit_airport(4),
    "pit_flight_asof": f"""
WITH {_FLIGHTS},{_NEWEST_FLIGHTS}
{_PIT_FLIGHT_SELECT}
FROM flights f ASOF LEFT JOIN newest n
  ON n.flight_number = f.flight_number AND n.timestamp <= f.timestamp""",
    "pit_flight_exact": f"""
WITH {_FLIGHTS},{_NEWEST_FLIGHTS}
{_PIT_FLIGHT_SELECT}
FROM flights f LEFT JOIN newest n
  ON n.flight_number = f.flight_number AND n.timestamp = f.timestamp""",
    "serve_two_groups": f"""
WITH {_AIRPORTS},{_NEWEST_FLIGHTS}
{_PIT_FLIGHT_SELECT},
       round(a.average_departure_delay, 8) AS average_departure_delay
FROM flights f
ASOF LEFT JOIN newest n ON n.flight_number = f.flight_number AND n.timestamp <= f.timestamp
ASOF LEFT JOIN airports a
  ON a.origin_airport_id = f.origin_airport_id AND a.timestamp <= f.timestamp""",
    "latest_airport_features": f"""
WITH {_AIRPORTS}
SELECT max(timestamp) AS timestamp, origin_airport_id,
       round(arg_max(average_departure_delay, timestamp), 8) AS average_departure_delay
FROM airports GROUP BY origin_airport_id""",
    "training_set_part1": f"""
WITH {_PART1}
SELECT event_id, {_DATASET_COLUMNS},
       CASE WHEN day < '{SPLIT}' THEN 'train' ELSE 'test' END AS part
FROM rows""",
    "training_set_part2": f"""
WITH {_SERVED}
SELECT event_id, round(departure_delay_minutes, 8) AS departure_delay_minutes,
       round(taxi_out_minutes, 8) AS taxi_out_minutes,
       round(distance_miles, 8) AS distance_miles,
       round(average_departure_delay, 8) AS average_departure_delay,
       target,
       CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN 'train' ELSE 'test' END AS part
FROM joined""",
    "training_set_from_files": f"""
WITH {_SERVED}
SELECT round(departure_delay_minutes, 8) AS departure_delay_minutes,
       round(taxi_out_minutes, 8) AS taxi_out_minutes,
       round(distance_miles, 8) AS distance_miles,
       round(average_departure_delay, 8) AS average_departure_delay,
       target,
       CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN 'train' ELSE 'test' END AS part
FROM joined""",
    "time_split_counts": f"""
WITH {_FLIGHTS}
SELECT CASE WHEN timestamp < TIMESTAMP '{SPLIT}' THEN 'train' ELSE 'test' END AS part,
       count(*) AS n, count(*) FILTER (arrival_delay_minutes > 15) AS late
FROM flights WHERE NOT is_cancelled GROUP BY 1""",
    "first_n_test_rows": f"""
WITH {_PART1}
SELECT event_id, {_DATASET_COLUMNS}
FROM rows WHERE day >= '{SPLIT}' ORDER BY event_id LIMIT 1000""",
    "feature_statistics": "\nUNION ALL\n".join(
        f"""
SELECT '{name}' AS feature, round(m, 6) AS median, round(avg(coalesce(x, m)), 6) AS mean,
       round(stddev_pop(coalesce(x, m)), 6) AS std
FROM (WITH {_PART1} SELECT "{name}" AS x, (SELECT median("{name}") FROM rows) AS m FROM rows)
GROUP BY m"""
        for name in ("DepDelay", "TaxiOut", "Distance")
    ),
    "median_impute": f"""
WITH {_PART1},
middle AS (
  SELECT median("DepDelay") AS a, median("TaxiOut") AS b, median("Distance") AS c FROM rows
)
SELECT event_id, round(coalesce("DepDelay", a), 8) AS "DepDelay",
       round(coalesce("TaxiOut", b), 8) AS "TaxiOut",
       round(coalesce("Distance", c), 8) AS "Distance", target
FROM rows, middle""",
    "standardise": f"""
WITH {_PART1},
middle AS (
  SELECT median("DepDelay") AS a, median("TaxiOut") AS b, median("Distance") AS c FROM rows
),
filled AS (
  SELECT event_id, coalesce("DepDelay", a) AS a, coalesce("TaxiOut", b) AS b,
         coalesce("Distance", c) AS c, target
  FROM rows, middle
)
SELECT event_id,
       round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 8) AS "DepDelay",
       round((b - avg(b) OVER ()) / stddev_pop(b) OVER (), 8) AS "TaxiOut",
       round((c - avg(c) OVER ()) / stddev_pop(c) OVER (), 8) AS "Distance", target
FROM filled""",
    "score_fixed_weights": f"WITH {_SCORED} SELECT event_id, target, score, prediction FROM scored",
    "confusion_matrix": f"WITH {_SCORED} {_CONFUSION}",
    "roc_curve": _roc(thinned=False),
    "roc_curve_thinned": _roc(thinned=True),
    "enrich_and_score": _ENRICHED,
    "stream_enrich_score": _ENRICHED,
    "score_from_store": _fitted_requests(),
    "stream_score_from_store": _fitted_requests(),
    "train_weights": f"""
WITH {_RAW_FIT}
SELECT unnest(['DepDelay', 'TaxiOut', 'Distance', 'intercept']) AS feature,
       unnest([round(w0, 4), round(w1, 4), round(w2, 4), round(w3, 4)]) AS weight
FROM fit""",
    "train_and_evaluate_raw": f"WITH {_RAW_FIT},{_fit_scored(_RAW_NAMES, 'test')} {_CONFUSION}",
    "train_and_evaluate": f"""
WITH {_SERVED},
train AS (SELECT * FROM joined WHERE timestamp < TIMESTAMP '{SPLIT}'),
test AS (SELECT * FROM joined WHERE timestamp >= TIMESTAMP '{SPLIT}'),
{_newton("train", _JOINED_NAMES)},
{_fit_scored(_JOINED_NAMES, "test")}
{_CONFUSION}""",
    "train_and_evaluate_roc": f"""
WITH {_SERVED},
train AS (SELECT * FROM joined WHERE timestamp < TIMESTAMP '{SPLIT}'),
test AS (SELECT * FROM joined WHERE timestamp >= TIMESTAMP '{SPLIT}'),
{_newton("train", _JOINED_NAMES)},
probability AS (
  SELECT target, 1 / (1 + exp(-({_margin(_JOINED_NAMES, "r")}))) AS score FROM test r, fit, scale, middle
),
{_curve("probability", thinned=True, digits=16, after=_CORNERS)}""",
    "fitted_scores": f"""
WITH {_RAW_FIT}
SELECT event_id, target, {_margin(_RAW_NAMES, "r")} > 0 AS prediction,
       round(1 / (1 + exp(-({_margin(_RAW_NAMES, "r")}))), 5) AS score
FROM test r, fit, scale, middle""",
    "stream_score": f"""
WITH {_RAW_FIT},{_fit_scored(_RAW_NAMES, "rows")}
SELECT event_id, target, prediction FROM scored""",
}

"""The two SQL dialects that models are rendered for: Spark, and the one that checks results."""

from __future__ import annotations

from lakeloom.functions.core import _pads


class Spark:
    name = "spark"

    def json_int(self, col: str, field: str) -> str:
        return f"CAST(get_json_object({col}, '$.{field}') AS INT)"

    def key(self, *cols: str) -> str:
        return f"sha2(concat_ws('||', {self._parts(cols)}), 256)"

    def _parts(self, cols) -> str:
        return ", ".join(f"coalesce(CAST({c} AS STRING), '_null_')" for c in cols)

    def hmac(self, col: str, salt: str) -> str:
        i, o = _pads(salt)
        return f"sha2(concat(unhex('{o}'), unhex(sha2(concat(unhex('{i}'), encode({col}, 'UTF-8')), 256))), 256)"

    def days(self, end: str, start: str) -> str:
        return f"CAST(datediff({end}, {start}) AS BIGINT)"

    def micros(self, ts: str) -> str:
        return f"unix_micros(CAST({ts} AS TIMESTAMP))"

    def seconds(self, end: str, start: str) -> str:
        return f"CAST(floor((unix_micros(CAST({end} AS TIMESTAMP)) - unix_micros(CAST({start} AS TIMESTAMP))) / 1000000) AS BIGINT)"

    def median(self, x: str) -> str:
        return f"percentile_approx({x}, 0.5, 1000000)"

    def week(self, x: str) -> str:
        return f"CAST(date_trunc('week', {x}) AS DATE)"

    def pick(self, expr: str, values: list) -> str:
        lit = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
        return f"CASE {expr} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"

    def matches(self, col: str, pattern: str) -> str:
        return f"{col} RLIKE '{pattern}'"

    def series(self, first: str, last: str) -> str:
        return f"SELECT explode(sequence(DATE'{first}', DATE'{last}', INTERVAL 1 DAY)) AS full_date"

    day_of_week = "dayofweek({0})"
    iso_week = "weekofyear({0})"
    month_name = "date_format({0}, 'MMMM')"
    day_name = "date_format({0}, 'EEEE')"
    ymd = "CAST(date_format({0}, 'yyyyMMdd') AS INT)"


class Duck(Spark):
    name = "duck"

    def json_int(self, col: str, field: str) -> str:
        return f"CAST(json_extract_string({col}, '$.{field}') AS INT)"

    def key(self, *cols: str) -> str:
        return f"sha256(concat_ws('||', {self._parts(cols)}))"

    def hmac(self, col: str, salt: str) -> str:
        i, o = _pads(salt)
        return f"sha256(unhex('{o}') || unhex(sha256(unhex('{i}') || encode({col}))))"

    def days(self, end: str, start: str) -> str:
        return f"date_diff('day', {start}, {end})"

    def micros(self, ts: str) -> str:
        return f"epoch_us({ts})"

    def seconds(self, end: str, start: str) -> str:
        return f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 1000000) AS BIGINT)"

    def median(self, x: str) -> str:
        return f"quantile_disc({x}, 0.5)"

    def matches(self, col: str, pattern: str) -> str:
        return f"regexp_matches({col}, '{pattern}')"

    def series(self, first: str, last: str) -> str:
        return f"SELECT CAST(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS DATE) AS full_date"

    day_of_week = "CAST(dayofweek({0}) + 1 AS INT)"
    iso_week = "CAST(weekofyear({0}) AS INT)"
    month_name = "monthname({0})"
    day_name = "dayname({0})"
    ymd = "CAST(strftime({0}, '%Y%m%d') AS INT)"


SPARK, DUCK = Spark(), Duck()

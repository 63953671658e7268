"""The few spellings in which Spark's SQL and the reference SQL differ."""

from __future__ import annotations


class Spark:
    def pct(self, x, p):
        return f"percentile({x}, {p})"

    def median(self, x):
        return self.pct(x, "0.5e0")

    def text(self, x):
        return f"cast({x} AS STRING)"

    def joined(self, x):
        return f"array_join(array_sort(collect_set({x})), ';')"

    def sub(self, s, pattern, to):
        return "regexp_replace({}, '{}', '{}')".format(s, pattern.replace("\\", "\\\\"), to)

    def has(self, s, pattern):
        return "{} RLIKE '{}'".format(s, pattern.replace("\\", "\\\\"))

    def extract(self, s, pattern, group):
        return "regexp_extract({}, '{}', {})".format(s, pattern.replace("\\", "\\\\"), group)

    def json(self, s, key):
        return f"get_json_object({s}, '$.{key}')"

    def hash32(self, s):
        return f"cast(conv(substr(md5({s}), 1, 8), 16, 10) AS BIGINT)"

    def sha(self, s):
        return f"sha2({s}, 256)"

    def days(self, a, b):
        return f"cast(datediff(cast({a} AS DATE), cast({b} AS DATE)) AS BIGINT)"

    def seconds(self, a):
        return f"unix_seconds(cast({a} AS TIMESTAMP))"

    def offsets(self, values, name):
        return f"(SELECT explode(array({', '.join(map(str, values))})) AS {name})"

    def series(self, n, name):
        return f"(SELECT explode(sequence(1, {n})) AS {name})"

    def words(self, s):
        return f"filter(split({s}, ' '), w -> w <> '')"

    def size(self, a):
        return f"size({a})"

    def two_digits(self, x):
        return f"lpad(cast({x} AS STRING), 2, '0')"


class DuckDB(Spark):
    def pct(self, x, p):
        return f"quantile_cont({x}, {p})"

    def joined(self, x):
        return f"array_to_string(list_sort(list_distinct(list({x}))), ';')"

    def sub(self, s, pattern, to):
        return f"regexp_replace({s}, '{pattern}', '{to}', 'g')"

    def has(self, s, pattern):
        return f"regexp_matches({s}, '{pattern}')"

    def extract(self, s, pattern, group):
        return f"regexp_extract({s}, '{pattern}', {group})"

    def json(self, s, key):
        return f"json_extract_string({s}, '$.{key}')"

    def hash32(self, s):
        return f"cast('0x' || substr(md5({s}), 1, 8) AS BIGINT)"

    def sha(self, s):
        return f"sha256({s})"

    def days(self, a, b):
        return f"date_diff('day', cast({b} AS DATE), cast({a} AS DATE))"

    def seconds(self, a):
        return f"cast(floor(epoch({a})) AS BIGINT)"

    def offsets(self, values, name):
        return f"(SELECT unnest([{', '.join(map(str, values))}]) AS {name})"

    def series(self, n, name):
        return f"(SELECT unnest(generate_series(1, {n})) AS {name})"

    def words(self, s):
        return f"list_filter(string_split({s}, ' '), lambda w: w <> '')"

    def size(self, a):
        return f"len({a})"

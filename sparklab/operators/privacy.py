"""Sensitive-data inspection and de-identification with built-in functions.

Detectors are regular expressions written in the subset shared by Java and
RE2 (no look-around, no back-references) so the same rule table runs in Spark
and in SQL oracles.  All detectors run in ONE pass: each text yields one array
of findings (per-detector ``regexp_extract_all`` concatenated), exploded once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklab.functions.core import md5num

# Detector rules (info type, pattern, base likelihood).
DETECTORS = [
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "LIKELY"),
    ("CREDIT_CARD_NUMBER", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", "POSSIBLE"),
    ("PHONE_NUMBER", r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}", "LIKELY"),
    ("IP_ADDRESS", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "POSSIBLE"),
    ("AUTH_TOKEN", r"(?i)(?:api[_-]?key|secret|token|password) *[:=] *\"?[A-Za-z0-9]{16,}\"?", "VERY_LIKELY"),
]

LIKELIHOOD_ORDER = ["VERY_UNLIKELY", "UNLIKELY", "POSSIBLE", "LIKELY", "VERY_LIKELY"]

# Necessary conditions of the detectors above (a text failing all of them cannot
# produce a finding): a cheap exact pre-filter before the extraction passes.
NECESSARY = {
    "EMAIL_ADDRESS": ("contains", "@"),
    "CREDIT_CARD_NUMBER": ("rlike", "[0-9]"),
    "PHONE_NUMBER": ("rlike", "[0-9]"),
    "IP_ADDRESS": ("rlike", "[0-9]"),
    "AUTH_TOKEN": ("rlike", "(?i)(api[_-]?key|secret|token|password)"),
}


def may_match(text: Column, detectors: list[tuple] | None = None) -> Column | None:
    """OR of the detectors' necessary conditions; None when a detector has none
    (then every text must be scanned)."""
    conds = []
    for t, _, _ in (detectors or DETECTORS):
        if t not in NECESSARY:
            return None
        kind, arg = NECESSARY[t]
        c = text.contains(arg) if kind == "contains" else text.rlike(arg)
        if all(str(c) != str(x) for x in conds):
            conds.append(c)
    out = None
    for c in conds:
        out = c if out is None else out | c
    return out


def luhn_ok(digits: Column) -> Column:
    """Luhn checksum of a digit string (non-digits removed), with array functions."""
    d = F.regexp_replace(digits, "[^0-9]", "")
    n = F.length(d)
    idx = F.sequence(F.lit(1), n)
    vals = F.transform(idx, lambda i: F.substring(d, n - i + 1, 1).cast("int"))  # right to left
    dbl = F.transform(vals, lambda v, i: F.when(i % 2 == 1, F.when(v * 2 > 9, v * 2 - 9).otherwise(v * 2)).otherwise(v))
    s = F.aggregate(dbl, F.lit(0), lambda acc, v: acc + v)
    return (n >= 12) & (s % 10 == 0)


def inspect_infotypes(df: DataFrame, key: str, text: str, detectors: list[tuple] | None = None,
                      id_fields: list[str] = (), with_offsets: bool = False) -> DataFrame:
    """Findings table: row key, info type, quote, likelihood and up to three
    identifying fields.  Cards passing Luhn are raised to LIKELY."""
    dets = detectors or DETECTORS

    def finding(t, lk, p):
        if not with_offsets:
            return lambda m: F.struct(F.lit(t).alias("info_type"), m.alias("quote"), F.lit(lk).alias("likelihood"))
        # 0-based start of the i-th match: lengths of the pieces before it
        # (``split`` around the same pattern) plus the earlier matches
        pieces = F.split(F.col(text), p, -1)
        matches = F.regexp_extract_all(F.col(text), F.lit(p), 0)

        def total(arr):
            return F.aggregate(arr, F.lit(0), lambda acc, s: acc + F.length(s))
        return lambda m, i: F.struct(F.lit(t).alias("info_type"), m.alias("quote"), F.lit(lk).alias("likelihood"),
                                     (total(F.slice(pieces, 1, i + 1)) + total(F.slice(matches, 1, i))).alias("start"))
    arrays = [F.transform(F.regexp_extract_all(F.col(text), F.lit(p), 0), finding(t, lk, p)) for t, p, lk in dets]
    pre = may_match(F.col(text), dets)
    src = df.where(pre) if pre is not None else df  # exact: texts failing it have no finding
    f = src.select(key, *id_fields[:3], F.explode(F.concat(*arrays)).alias("f")).select(key, *id_fields[:3], "f.*")
    lk = F.when((F.col("info_type") == "CREDIT_CARD_NUMBER") & luhn_ok(F.col("quote")), F.lit("LIKELY")) \
          .otherwise(F.col("likelihood"))
    return f.withColumn("likelihood", lk)


def dictionary_findings(df: DataFrame, key: str, text: str, dictionary: DataFrame, info_type: str,
                        term_col: str = "term") -> DataFrame:
    """Dictionary detector: word tokens joined to a term table (Catalyst/AQE
    broadcast it only when its runtime size is small)."""
    toks = df.select(key, F.explode(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+")).alias("tok"))
    d = dictionary.select(F.lower(F.col(term_col)).alias("tok")).distinct()
    return toks.join(d, "tok").groupBy(key, "tok").agg(F.count(F.lit(1)).alias("occurrences")).select(
        key, F.lit(info_type).alias("info_type"), F.col("tok").alias("quote"), "occurrences")


def apply_rules(findings: DataFrame, df: DataFrame, key: str, text: str, hotwords: dict | None = None,
                exclusions: dict | None = None, window: int = 30, min_likelihood: str = "POSSIBLE") -> DataFrame:
    """Hotword rules (a word within ``window`` characters before the match raises
    likelihood one level), exclusion rules (a regex on the quote drops it) and
    a minimum likelihood.  ``findings`` carry the 0-based ``start`` of each match
    (``inspect_infotypes(..., with_offsets=True)``), so equal quotes at several
    places are judged each by its own context."""
    j = findings.join(df.select(key, text), key)
    ctx = F.lower(F.expr(f"substring(`{text}`, greatest(start + 1 - {window}, 1), least(start, {window}))"))
    order = F.array(*[F.lit(x) for x in LIKELIHOOD_ORDER])
    lvl = F.array_position(order, F.col("likelihood"))
    for t, words in (hotwords or {}).items():
        hit = F.lit(False)
        for w in words:
            hit = hit | ctx.contains(w.lower())
        lvl = F.when((F.col("info_type") == t) & hit, F.least(lvl + 1, F.lit(len(LIKELIHOOD_ORDER)))) \
               .otherwise(lvl)
    j = j.withColumn("_lvl", lvl)
    for t, pat in (exclusions or {}).items():
        j = j.where(~((F.col("info_type") == t) & F.col("quote").rlike(pat)))
    j = j.where(F.col("_lvl") >= LIKELIHOOD_ORDER.index(min_likelihood) + 1)
    return j.withColumn("likelihood", F.element_at(order, F.col("_lvl").cast("int"))).drop("_lvl", text)


def profile_sensitivity(df: DataFrame, table: str, cols: list[str] | None = None) -> DataFrame:
    """Share of rows per string column that contain any detector match."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    aggs = []
    for c in cols:
        for t, p, _ in DETECTORS:
            aggs.append(F.avg(F.col(c).rlike(p).cast("int")).alias(f"{c}__{t}"))
    wide = df.agg(*aggs)
    stack = ", ".join([f"'{c}', '{t}', `{c}__{t}`" for c in cols for t, _, _ in DETECTORS])
    n = len(cols) * len(DETECTORS)
    out = wide.selectExpr(f"stack({n}, {stack}) as (column_name, info_type, share)")
    return out.withColumn("table_name", F.lit(table)).where(F.col("share") > 0)


# ------------------------------------------------------------------ transforms ---

def _patterns(types: list[str] | None):
    return [(t, p) for t, p, _ in DETECTORS if types is None or t in types]


def _guarded(x: Column, out: Column, types: list[str] | None) -> Column:
    """Run the replacement chain only on texts that can contain a match."""
    dets = [d for d in DETECTORS if types is None or d[0] in types]
    pre = may_match(x, dets)
    return out if pre is None else F.when(pre, out).otherwise(x)


def redact(c, types: list[str] | None = None) -> Column:
    x0 = F.col(c) if isinstance(c, str) else c
    x = x0
    for _, p in _patterns(types):
        x = F.regexp_replace(x, p, "")
    return _guarded(x0, x, types)


def replace_with_type(c, types: list[str] | None = None) -> Column:
    x0 = F.col(c) if isinstance(c, str) else c
    x = x0
    for t, p in _patterns(types):
        x = F.regexp_replace(x, p, f"[{t}]")
    return _guarded(x0, x, types)


CARD_MASK_PATTERN = r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?([0-9]{4})"


def mask_cards(c) -> Column:
    """Mask card numbers, keeping the last four digits."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(x, CARD_MASK_PATTERN, "****-****-****-$1")


def hash_value(c, key: str) -> Column:
    """One-way keyed hash (joins on the hashed value still work)."""
    return F.sha2(F.concat(F.lit(key), F.col(c).cast("string")), 256)


def encrypt_deterministic(c, key: str) -> Column:
    """Reversible and deterministic (AES-ECB, base64): equal inputs give equal
    outputs so joins survive.  ECB leaks equality by design; use only for
    identifiers, never for free text."""
    return F.base64(F.aes_encrypt(F.col(c).cast("string"), F.lit(key), F.lit("ECB")))


def decrypt_deterministic(c, key: str) -> Column:
    return F.aes_decrypt(F.unbase64(F.col(c)), F.lit(key), F.lit("ECB")).cast("string")


def bucket_value(c, size: float) -> Column:
    return (F.floor(F.col(c) / size) * size)


def date_shift(d, entity, key: str, max_days: int = 100) -> Column:
    """Shift by the same pseudo-random offset (in [-max_days, max_days]) per
    entity: order and durations within an entity survive."""
    off = F.pmod(md5num(F.concat(F.col(entity).cast("string"), F.lit(key))), F.lit(2 * max_days + 1)) - max_days
    return F.date_add(F.to_date(F.col(d)), off.cast("int"))


def time_extract(d, part: str = "year_month") -> Column:
    if part == "year":
        return F.year(F.col(d))
    return F.date_format(F.col(d), "yyyy-MM")


def deidentify_records(df: DataFrame, rules: dict) -> DataFrame:
    """Column-level (record) transforms: ``{column: callable(column_name) -> Column}``."""
    return df.select(*[rules[c](c).alias(c) if c in rules else F.col(c) for c in df.columns])


def deidentify_text(df: DataFrame, text: str, mode: str = "replace", types: list[str] | None = None) -> DataFrame:
    """Match-level transforms inside free text."""
    fn = {"replace": replace_with_type, "redact": redact}[mode]
    return df.withColumn(text, fn(text, types))

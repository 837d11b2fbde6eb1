"""Projections, predicates and cleaning (row-local: no shuffle anywhere here)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklab.functions.core import blank_to_null, col, regexp_extract_or_null


def clean_text_table(df: DataFrame, id_col: str, text_col: str, id_format: str = "R%05d",
                     nullable_text: list[str] = (), flag_cols: dict | None = None,
                     keep: list[str] = ()) -> DataFrame:
    """Formatted id, trimmed text, blank optional texts -> NULL, int flags -> bool,
    rows with a blank main text dropped."""
    flag_cols = flag_cols or {}
    sel = [F.format_string(id_format, F.col(id_col)).alias("review_id")]
    sel += [blank_to_null(c).alias(c) for c in nullable_text]
    sel += [F.trim(F.col(text_col)).alias(text_col)]
    sel += [(F.col(c) == F.lit(v)).alias(name) for name, (c, v) in flag_cols.items()]
    sel += [F.col(c) for c in keep]
    return df.where(F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != "")).select(*sel)


def text_summary(df: DataFrame, text_col: str) -> DataFrame:
    n = F.length(F.col(text_col))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(n).alias("min_len"), F.max(n).alias("max_len"),
                  F.round(F.avg(n), 1).alias("avg_len"))


def load_audit(df: DataFrame, text_col: str, numeric_text_cols: list[str] = ()) -> DataFrame:
    """Rows loaded, blank texts and, per string column meant to be numeric, the
    values that do not cast (right after a load)."""
    aggs = [F.count(F.lit(1)).alias("rows_loaded"),
            F.count_if(F.col(text_col).isNull() | (F.trim(F.col(text_col)) == "")).alias("blank_text")]
    for c in numeric_text_cols:
        aggs.append(F.count_if(F.col(c).isNotNull() &
                               F.expr(f"try_cast(trim(`{c}`) as double)").isNull()).alias(f"uncastable_{c}"))
    return df.agg(*aggs)


def select_except(df: DataFrame, *cols: str) -> DataFrame:
    """``SELECT * EXCEPT (a, b)``."""
    return df.drop(*cols)


def struct_star(df: DataFrame, struct_col: str, except_fields: list[str] = ()) -> DataFrame:
    """Expand a struct column into columns, minus some fields (``s.* EXCEPT (...)``)."""
    others = [c for c in df.columns if c != struct_col]
    fields = [f for f in df.schema[struct_col].dataType.fieldNames() if f not in except_fields]
    return df.select(*others, *[F.col(f"{struct_col}.{f}").alias(f) for f in fields])


def between_filter(df: DataFrame, c: str, lo, hi) -> DataFrame:
    return df.where(F.col(c).between(lo, hi))


def filename_from_uri(c) -> Column:
    """Last path segment of a URI (NULL when there is none)."""
    return regexp_extract_or_null(c, r"([^/]+)$", 1)


def normalize_title(c) -> Column:
    """Lower case, punctuation removed, whitespace collapsed."""
    x = F.lower(col(c))
    x = F.regexp_replace(x, r"[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(x, r" +", " "))


def json_array_explode(df: DataFrame, json_col: str, path: str, out: str) -> DataFrame:
    """``UNNEST(JSON_QUERY_ARRAY(j, path))`` of string items."""
    arr = F.from_json(F.get_json_object(F.col(json_col), path), "array<string>")
    return df.select(*[c for c in df.columns if c != json_col], F.explode(arr).alias(out))


def prob_for_label(probs_col: str, label: str) -> Column:
    """``(SELECT prob FROM UNNEST(probs) WHERE label = 'Yes')`` as a higher-order filter."""
    return F.element_at(F.filter(F.col(probs_col), lambda x: x["label"] == F.lit(label)), 1)["prob"]

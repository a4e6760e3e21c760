"""Registry labels: encoding, decoding, merging.

Labels hold no dots, so a metric travels as ``0-8750`` and is read back as 0.875.
A negative metric does not survive the way back (it reads as 0.0); that is the
format's own limit and kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label names, the metadata key each is taken from, the labels that always fit, and their number.
METRIC_LABELS = {"r2-score": "r2_score", "rmse": "rmse", "mae": "mae", "mse": "mse", "quality-score": "quality_score"}
STATUS_LABEL = "eval-status"
STATUS_KEY = "evaluation_status"
LABEL_LIMIT = 10
READY = {"ready-for-promotion": "true"}
ENVIRONMENT = "prd-test"


def encode_text_label(column: Column, length: int | None = None) -> Column:
    """Lower-case text with every other sign than a-z, 0-9, _ and - as a dash; cut only to a caller's length."""
    text = F.regexp_replace(F.lower(column), "[^a-z0-9_-]", "-")
    return text if length is None else F.substring(text, 1, length)


def encode_metric_label(column: Column) -> Column:
    """Four decimals with a dash for the dot; null for what is no number."""
    number = column.try_cast("double")
    return F.replace(number.try_cast("decimal(38,4)").cast("string"), F.lit("."), F.lit("-"))


def decode_metric_label(column: Column) -> Column:
    """The number behind a label; 0.0 where there is none."""
    return F.coalesce(F.replace(column, F.lit("-"), F.lit(".")).try_cast("double"), F.lit(0.0))


def promotion_labels(metadata: Column, build_number: str = "unknown") -> Column:
    """Label map of an evaluated model from its metadata map; unusable metrics are left out."""
    fixed = {**READY, "harness-build-id": build_number, "env": ENVIRONMENT}
    entries = [(F.lit(k), F.lit(v)) for k, v in fixed.items()]
    entries += [(F.lit(label), encode_metric_label(metadata[key])) for label, key in METRIC_LABELS.items()]
    entries.append((F.lit(STATUS_LABEL), encode_text_label(metadata[STATUS_KEY])))
    pairs = F.array(*[F.struct(k.alias("key"), v.alias("value")) for k, v in entries])
    return F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))


def budget_labels(labels: Column, build_number: str = "unknown", limit: int = LABEL_LIMIT) -> Column:
    """What a store with room for ``limit`` labels takes (``stored``) and what it does not (``overflow``).

    Nothing is lost: above the limit the essential labels are stored and all given ones are the overflow. Tables have
    no such limit, so the registry keeps all labels; ``for_limited_store`` hands them on.
    """
    essential = {**READY, "build-id": build_number, "environment": ENVIRONMENT}
    pairs = [F.lit(part) for item in essential.items() for part in item]
    over = F.size(labels) > limit
    none = F.create_map().cast("map<string,string>")
    return F.struct(
        F.when(over, F.create_map(*pairs)).otherwise(labels).alias("stored"), F.when(over, labels).otherwise(none).alias("overflow")
    )


def literal_map(values: Mapping[str, str | Column]) -> Column:
    parts: list[Column] = []
    for key, value in values.items():
        parts += [F.lit(key), value if isinstance(value, Column) else F.lit(value)]
    return F.create_map(*parts) if parts else F.create_map().cast("map<string,string>")


def merge_labels(additions: Column, source: Column, forced: Mapping[str, str] | None = None) -> Column:
    """Source labels win over additions; forced labels win over both."""
    source = F.coalesce(source, F.create_map().cast("map<string,string>"))
    merged = F.map_concat(F.map_filter(additions, lambda k, _: ~F.map_contains_key(source, k)), source)
    if not forced:
        return merged
    return F.map_concat(F.map_filter(merged, lambda k, _: ~k.isin(*forced)), literal_map(forced))

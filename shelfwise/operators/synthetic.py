"""A synthetic catalog drawn per key of a given frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import bonus
from shelfwise.functions.hashing import hash_choice, hash_normal

# Categories, bonuses and shape of the generated catalog.
COUNTRIES = ("France", "Italy", "Spain", "USA", "Australia", "Chile", "Argentina")
KINDS = ("Red", "White", "Rosé")
GRAPES = (
    "Cabernet Sauvignon", "Merlot", "Pinot Noir", "Chardonnay", "Sauvignon Blanc",
    "Riesling", "Tempranillo", "Sangiovese", "Syrah", "Grenache",
)
STYLES = ("Rich", "Light", "Crisp", "Smooth", "Bold", "Elegant", "Fresh", "Complex")
COUNTRY_POINTS = {"France": 3, "Italy": 2, "Spain": 1, "USA": 2, "Australia": 1, "Chile": 0, "Argentina": 0}
KIND_POINTS = {"Red": 1, "White": 0, "Rosé": -1}
STYLE_POINTS = {"Complex": 3, "Elegant": 2, "Rich": 1, "Bold": 1, "Smooth": 0, "Fresh": 0, "Crisp": -1, "Light": -1}
LOG_PRICE_MEAN, LOG_PRICE_SD = 2.5, 0.8
BASE_POINTS, PRICE_POINTS, PRICE_FACTOR, NOISE_POINTS = 85.0, 15.0, 2.0, 2.0
LOW_POINTS, HIGH_POINTS = 80.0, 100.0


def generate_catalog(keys: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """One synthetic product per key: price, categories and a rating that depends on them.

    Every draw is a hash of seed and key, so the catalog is the same on any
    cluster and grows with the keys.
    """
    k = F.col(key)

    def draw(name: str) -> str:
        return f"{seed}-{name}"

    def rating(price: Column) -> Column:
        raw = (
            F.lit(BASE_POINTS) + F.least(F.lit(PRICE_POINTS), F.ln(price) * PRICE_FACTOR)
            + bonus(F.col("country"), COUNTRY_POINTS, 0) + bonus(F.col("kind"), KIND_POINTS, 0)
            + bonus(F.col("style"), STYLE_POINTS, 0) + hash_normal(k, draw("noise"), NOISE_POINTS)
        )
        return F.greatest(F.lit(LOW_POINTS), F.least(F.lit(HIGH_POINTS), raw))

    return (
        keys.select(
            k, F.exp(F.lit(LOG_PRICE_MEAN) + hash_normal(k, draw("price"), LOG_PRICE_SD)).alias("drawn"),
            hash_choice(k, draw("country"), COUNTRIES).alias("country"),
            hash_choice(k, draw("kind"), KINDS).alias("kind"),
            hash_choice(k, draw("grape"), GRAPES).alias("grape"),
            hash_choice(k, draw("style"), STYLES).alias("style"),
        )
        .select(
            key, F.round("drawn", 2).alias("price"), "country", "kind", "grape", "style",
            F.round(rating(F.col("drawn")), 1).alias("rating"),
        )
    )

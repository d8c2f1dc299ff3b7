"""Aliases and settings kept in files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.config import RankingConfig

# Names under which shares and entities are looked for, in this order.
SHARE_NAMES = ["share", "share_%", "usage_%", "share frac", "share_frac"]
DECLARED_NAMES = ["Share_frac", "Share_%", "Usage_%", "share_%", "usage_%", "Share", "Usage", "Meta_%"]
ENTITY_NAMES = ["deck", "archetype", "name"]
DECLARED_ENTITIES = ["Deck", "deck", "Deck Name", "DeckName", "Name", "Archetype", "Alias"]


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(pos, canonical, spelling) from a JSON object of canonical names with lists of variants, the name itself included.

    Without the file, or where it holds no such object, there are no rows.
    """
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "pos int, canonical string, spelling string")
    names = F.map_entries(F.from_json("value", "map<string, array<string>>"))
    rows = text.select(F.posexplode(names).alias("pos", "e"))
    spellings = F.concat(F.array("e.key"), F.coalesce("e.value", F.array().cast("array<string>")))
    return rows.select("pos", F.col("e.key").alias("canonical"), F.explode(spellings).alias("spelling"))


def read_settings(path: str) -> RankingConfig:
    """Settings from a JSON file, or a YAML file where PyYAML is installed; a name that no setting has is an error."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError("YAML settings need PyYAML; use JSON") from e
        found = yaml.safe_load(text)
    else:
        found = json.loads(text)
    return RankingConfig.of({k: tuple(v) if isinstance(v, list) else v for k, v in (found or {}).items()})


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def declared_column(df: DataFrame) -> str | None:
    """The column of declared shares: the first of DECLARED_NAMES, else the first number."""
    return next((n for n in [*DECLARED_NAMES, *numeric(df)] if n in df.columns), None)


def declared_shares(df: DataFrame) -> DataFrame | None:
    """(deck, share) of a table of declared shares whose columns go by other names, for a ranking; None where it has no
    column of names or of shares. Names are trimmed and their rows summed; text that is no number counts 0."""
    entity = next((c for c in DECLARED_ENTITIES if c in df.columns), None)
    share = declared_column(df)
    if entity is None or share is None:
        return None
    number = F.coalesce(F.col(f"`{share}`").cast("string").try_cast("double"), F.lit(0.0))
    return df.select(F.trim(F.col(f"`{entity}`")).alias("deck"), number.alias("share")).groupBy("deck").agg(F.sum("share").alias("share"))


def entity_and_share(df: DataFrame) -> DataFrame:
    """(deck, share) of a usage table whose columns go by other names; names are trimmed, what is no number is 0.

    The entity is the first column called as in ENTITY_NAMES, else the first text; the share the first of
    SHARE_NAMES, else the first number. Case and outer space don't count.
    """
    plain = {c.strip().lower(): c for c in reversed(df.columns)}
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    entity = next((c for c in df.columns if c.strip().lower() in ENTITY_NAMES), texts[0] if texts else None)
    share = next((plain[n] for n in SHARE_NAMES if n in plain), next(iter(numeric(df)), None))
    if entity is None or share is None:
        raise KeyError(f"no column of entities or of shares among {df.columns}")
    return df.select(F.trim(F.col(f"`{entity}`")).alias("deck"), F.coalesce(F.col(f"`{share}`").cast("string").try_cast("double"), F.lit(0.0)).alias("share"))

"""Rule sets ("niches") as a small, explicitly typed DataFrame.

A rule set is parsed on the driver (one YAML file per niche, a few KB
each) and becomes one row of ``RULE_SCHEMA``. Rule sets known on the driver become constants of
the plan; a rules DataFrame is joined, and Spark picks the join by its size.
A niche has one rule set.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULES_DIR = Path(__file__).parent / "rulesets"

# Defaults applied when a rule file leaves a key out.
DEFAULT_MIN_TEXT_LENGTH = 50
DEFAULT_MAX_TEXT_LENGTH = 2000
DEFAULT_MIN_SAMPLES = 300
DEFAULT_MAX_PER_SOURCE = 200

RULE_SCHEMA = T.StructType([
    T.StructField("niche", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("positive_label", T.StringType(), False),
    T.StructField("negative_label", T.StringType(), False),
    T.StructField("positive_phrases", T.ArrayType(T.StringType(), False), False),
    T.StructField("negative_phrases", T.ArrayType(T.StringType(), False), False),
    T.StructField("positive_domains", T.ArrayType(T.StringType(), False), False),
    T.StructField("negative_domains", T.ArrayType(T.StringType(), False), False),
    T.StructField("min_samples_per_class", T.IntegerType(), False),
    T.StructField("min_text_length", T.IntegerType(), False),
    T.StructField("max_text_length", T.IntegerType(), False),
    T.StructField("max_per_source", T.IntegerType(), False),
])


@dataclass(frozen=True)
class RuleSet:
    niche: str
    positive_label: str
    negative_label: str
    positive_phrases: tuple[str, ...]
    negative_phrases: tuple[str, ...]
    positive_domains: tuple[str, ...]
    negative_domains: tuple[str, ...]
    description: str = ""
    min_samples_per_class: int = DEFAULT_MIN_SAMPLES
    min_text_length: int = DEFAULT_MIN_TEXT_LENGTH
    max_text_length: int = DEFAULT_MAX_TEXT_LENGTH
    max_per_source: int = DEFAULT_MAX_PER_SOURCE
    extra: dict = field(default_factory=dict, compare=False, repr=False)

    @classmethod
    def from_mapping(cls, cfg: dict) -> "RuleSet":
        """Build from a parsed config; lists are lower-cased once here."""
        missing = [k for k in ("niche", "positive_label", "negative_label") if k not in cfg]
        if missing:
            raise ValueError(f"rule set lacks keys: {missing}")

        def low(key):
            return tuple(str(x).lower() for x in (cfg.get(key) or []))

        return cls(
            niche=str(cfg["niche"]),
            description=str(cfg.get("description", "")),
            positive_label=str(cfg["positive_label"]),
            negative_label=str(cfg["negative_label"]),
            positive_phrases=low("positive_phrases"),
            negative_phrases=low("negative_phrases"),
            positive_domains=low("positive_domains"),
            negative_domains=low("negative_domains"),
            min_samples_per_class=int(cfg.get("min_samples_per_class", DEFAULT_MIN_SAMPLES)),
            min_text_length=int(cfg.get("min_text_length", DEFAULT_MIN_TEXT_LENGTH)),
            max_text_length=int(cfg.get("max_text_length", DEFAULT_MAX_TEXT_LENGTH)),
            max_per_source=int(cfg.get("max_per_source", DEFAULT_MAX_PER_SOURCE)),
        )

    def as_row(self) -> tuple:
        return (self.niche, self.description, self.positive_label, self.negative_label,
                list(self.positive_phrases), list(self.negative_phrases),
                list(self.positive_domains), list(self.negative_domains),
                self.min_samples_per_class, self.min_text_length, self.max_text_length,
                self.max_per_source)


def load_rule_set(niche: str, rules_dir: str | Path | None = None) -> RuleSet:
    """Load one rule set by name; a missing file is an error."""
    path = Path(rules_dir or RULES_DIR) / f"{niche}.yaml"
    if not path.exists():
        raise FileNotFoundError(f"no rule set for niche {niche!r} at {path}")
    with open(path, encoding="utf-8") as fh:
        return RuleSet.from_mapping(yaml.safe_load(fh))


def available_niches(rules_dir: str | Path | None = None, include_synthetic: bool = False) -> list[str]:
    names = sorted(p.stem for p in Path(rules_dir or RULES_DIR).glob("*.yaml"))
    return [n for n in names if include_synthetic or not n.startswith("synthetic_")]


def rules_frame(spark: SparkSession, rule_sets) -> DataFrame:
    """One row per rule set with ``RULE_SCHEMA``."""
    return spark.createDataFrame([r.as_row() for r in one_per_niche(rule_sets)], RULE_SCHEMA)


def one_per_niche(rule_sets) -> list[RuleSet]:
    """The rule sets as a list; a niche with two of them is an error."""
    sets = list(rule_sets)
    seen = [r.niche for r in sets]
    repeated = sorted({n for n in seen if seen.count(n) > 1})
    if repeated:
        raise ValueError(f"niches with more than one rule set: {repeated}")
    return sets


def load_rules(spark: SparkSession, niches=None, rules_dir=None) -> DataFrame:
    """Rules table for the named niches (all reference niches by default)."""
    names = niches or available_niches(rules_dir)
    return rules_frame(spark, [load_rule_set(n, rules_dir) for n in names])


def list_niches(spark: SparkSession, rules_dir=None) -> DataFrame:
    """Niche name and description, sorted by name."""
    return (load_rules(spark, rules_dir=rules_dir)
            .select("niche", "description").orderBy("niche"))


RULE_COLUMNS = [f.name for f in RULE_SCHEMA.fields if f.name != "niche"]
_RULE_TYPES = {f.name: f.dataType for f in RULE_SCHEMA.fields}


def _literal(value, dtype) -> Column:
    if isinstance(dtype, T.ArrayType) and len(value) > 64:      # one literal, not one a word
        return F.from_json(F.lit(json.dumps(list(value))), "array<string>")
    if isinstance(dtype, T.ArrayType):
        return F.array(*[F.lit(v) for v in value]).cast(dtype)
    return F.lit(value).cast(dtype)


def with_rules(df: DataFrame, rules, columns=None) -> DataFrame:
    """Attach each row's rule-set columns, keeping only rows of known niches.

    ``rules`` is a ``RuleSet``, a list of them, or a rules DataFrame. Rule
    sets known on the driver become literal columns (a ``CASE`` on
    ``niche`` when there are several), so there is no join at all and the
    text side is never shuffled. A rules DataFrame (one row per niche) is
    joined on ``niche``.
    """
    cols = list(columns or RULE_COLUMNS)
    if isinstance(rules, DataFrame):
        return df.join(rules.select("niche", *cols), on="niche", how="inner")
    sets = [rules] if isinstance(rules, RuleSet) else one_per_niche(rules)
    x = df.where(F.col("niche").isin([r.niche for r in sets]))
    added = {}
    for c in cols:
        dtype = _RULE_TYPES[c]
        if len(sets) == 1:
            added[c] = _literal(_value(sets[0], c), dtype)
        else:
            expr = None
            for r in sets:
                branch = _literal(_value(r, c), dtype)
                cond = F.col("niche") == r.niche
                expr = F.when(cond, branch) if expr is None else expr.when(cond, branch)
            added[c] = expr
    return x.withColumns(added)


def _value(rs: RuleSet, col: str):
    v = getattr(rs, col)
    return list(v) if isinstance(v, tuple) else v


def rule_sets_of(rules) -> list[RuleSet]:
    """Rule sets as a list, whichever form they were given in."""
    if isinstance(rules, RuleSet):
        return [rules]
    if isinstance(rules, DataFrame):  # one row per rule file
        return [RuleSet.from_mapping(r.asDict()) for r in rules.collect()]
    return list(rules)

"""Modality catalogs: categories and the questions asked in each.

A catalog is a hand-written YAML file, read on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import question_id
from ..functions.fixed_values import CONCEPT_QUESTIONS
from ..functions.prompts import DEFAULT_TEMPLATES


@dataclass(frozen=True)
class Category:
    name: str
    description: str
    questions: tuple[str, ...] = ()


@dataclass(frozen=True)
class Catalog:
    modality: str
    categories: tuple[Category, ...]

    @property
    def questions(self) -> tuple[str, ...]:
        return tuple(q for c in self.categories for q in c.questions)


def catalog_from_mapping(config: dict) -> Catalog:
    """``{modality, categories: {name: {description, questions: [{question}]}}}``."""
    if not isinstance(config, dict) or not config.get("categories"):
        raise ValueError("a catalog needs categories")
    categories = []
    for name, body in config["categories"].items():
        questions = tuple(str(q["question"]) for q in (body.get("questions") or []) if "question" in q)
        categories.append(Category(str(name), str(body.get("description", "")), questions))
    return Catalog(str(config.get("modality", "")), tuple(categories))


def read_catalog(path: str | Path, spark: SparkSession | None = None) -> Catalog:
    """The catalog of a YAML file: one beside the driver, or, with ``spark``, in any store that Spark reads."""
    import yaml

    if spark is None:
        content = Path(path).read_text(encoding="utf-8")
    else:
        content = "\n".join(r.value for r in spark.read.text(str(path), wholetext=True).collect())
    return catalog_from_mapping(yaml.safe_load(content))


def read_templates(path: str | Path) -> dict[str, str]:
    """The stage prompts of a configuration file (``prompt_templates``), defaults for the rest."""
    import yaml

    config = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    return {**DEFAULT_TEMPLATES, **(config.get("prompt_templates") or {})}


def concept_catalog() -> Catalog:
    """The built-in concepts as one category of yes/no questions."""
    text = "Yes/no questions about the built-in concepts."
    return Catalog("abdominal_ct", (Category("Concepts", text, tuple(CONCEPT_QUESTIONS.values())),))


def categories_frame(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """category, description, ord"""
    rows = [(c.name, c.description, i) for i, c in enumerate(catalog.categories)]
    return spark.createDataFrame(rows, "category string, description string, ord int")


def questions_frame(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """category, question, question_id, ord"""
    rows = [(c.name, q, i) for i, (c, q) in enumerate((c, q) for c in catalog.categories for q in c.questions)]
    frame = spark.createDataFrame(rows, "category string, question string, ord int")
    return frame.select("category", "question", question_id(F.col("question")).alias("question_id"), "ord")


def _order(seed: int, *parts: str) -> str:
    return hashlib.md5(":".join((str(seed), *parts)).encode()).hexdigest()


def sample_catalog(catalog: Catalog, categories: int = 4, questions: int = 10, seed: int = 42) -> Catalog:
    """A small catalog for trial runs: some categories, some questions of each.

    The same md5 order as the table samplers, so a seed gives one answer everywhere.
    """
    chosen = sorted(catalog.categories, key=lambda c: _order(seed, c.name))[:categories]
    return replace(
        catalog,
        categories=tuple(
            replace(c, questions=tuple(sorted(c.questions, key=lambda q: _order(seed, c.name, q))[:questions]))
            if len(c.questions) > questions
            else c
            for c in chosen
        ),
    )


def missing_questions(mapping: Iterable[str], catalog: Catalog) -> list[str]:
    """Mapped questions that the catalog does not ask."""
    return sorted(set(mapping) - set(catalog.questions))

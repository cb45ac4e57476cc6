"""Consent contact feed: per cohort, rows with an e-mail address, its protection swapped."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.privacy import KeyRing
from ..operators.filters import drop_null_tokens
from ..sources.publishing import Publication
from ..sources.readers import read_cohorts, split_damaged
from ..sources.writers import verify_written, write_lines, write_with_manifest


STORED, DAMAGED = "__stored", "line"


@dataclass(frozen=True)
class Settings:
    from_key: str = fixed.CONTACT_KEY_ID
    to_key: str = fixed.PERSON_KEY_ID
    protected: str = "EMAIL"
    tags: Sequence[str] = fixed.CONSENT_TAGS
    columns: Sequence[str] = fixed.CONTACT_COLUMNS
    null_words: Sequence[str] = ("null",)
    keys: KeyRing | None = field(default=None, repr=False)


def swapped(contacts: DataFrame, cfg: Settings) -> DataFrame:
    """Rows with an e-mail, its token moved from one key to the other in one expression.

    A token that does not open is null afterwards. A missing contract column raises.
    """
    if cfg.keys is None:
        raise ValueError("the contact feed needs the key ring")
    missing = sorted(set(cfg.columns) - set(contacts.columns))
    if missing:
        raise ValueError(f"the contacts lack {', '.join(missing)}")
    named = drop_null_tokens(contacts, cfg.protected, cfg.null_words)
    moved = cfg.keys.reprotect(F.col(cfg.protected), cfg.from_key, cfg.to_key)
    kept = [c for c in contacts.columns if c in set(cfg.columns) or c == "cohort"]
    return named.select(*[moved.alias(c) if c == cfg.protected else F.col(c) for c in kept], F.col(cfg.protected).alias(STORED))


def build(contacts: DataFrame, cfg: Settings) -> DataFrame:
    """The rows to publish: those whose e-mail token opens."""
    return swapped(contacts, cfg).filter(F.col(cfg.protected).isNotNull()).drop(STORED)


def unreadable(contacts: DataFrame, cfg: Settings) -> DataFrame:
    """Rows whose e-mail token does not open, with the token as it came."""
    bad = swapped(contacts, cfg).filter(F.col(cfg.protected).isNull())
    return bad.withColumn(cfg.protected, F.col(STORED)).drop(STORED)


@dataclass(frozen=True)
class Outcome:
    """What a run has done.

    ``status`` per cohort; manifest and read-back check (None when nothing was ready); counts of the rows set aside and of the
    lines that have more or fewer fields than their header; the cohorts that this run has published.
    """

    status: DataFrame
    manifest: dict[str, object] | None
    check: DataFrame | None
    unreadable: int = 0
    malformed: int = 0
    published: Sequence[str] = ()


def run(spark: SparkSession, folder: str, out: str, cfg: Settings, glob: str = "*.dat") -> Outcome:
    """All ready cohorts in one job, each to its own folder ``cohort=<tag>``, published as a whole.

    The run's folder under ``out`` holds ``feed``, ``unreadable`` (rows whose e-mail does not open) and ``malformed`` (lines that
    cannot be read, as they came), each by cohort, and manifests beside the first two. The feed is read back and
    compared cell by cell before the run is published (``sources.publishing``); if it differs, or the run fails, the last
    published outputs stay in force. Only the cohorts of this run are replaced.
    """
    contacts, status = read_cohorts(spark, folder, cfg.tags, glob=glob, damaged=DAMAGED)
    if contacts is None:
        return Outcome(status, None, None)
    ready = [r[0] for r in status.filter("status = 'ok'").select("cohort").collect()]
    sound, lines = split_damaged(contacts, DAMAGED)
    with Publication(spark, out) as publication:
        feed = build(sound, cfg)
        written = write_with_manifest(spark, feed, publication.path("feed"), fixed.FIELD_SEPARATOR, ["cohort"])
        aside = write_with_manifest(spark, unreadable(sound, cfg), publication.path("unreadable"), fixed.FIELD_SEPARATOR, ["cohort"])
        write_lines(lines, publication.path("malformed"), DAMAGED, ["cohort"])
        (checked,) = verify_written(spark, publication.path("feed"), written, feed.columns, fixed.FIELD_SEPARATOR).collect()
        malformed = spark.read.schema(f"{DAMAGED} string, cohort string").text(publication.path("malformed")).count()
        published = publication.commit(ready) if checked["ok"] else []
    check = spark.createDataFrame([tuple(checked)], "expected long, found long, ok boolean")
    return Outcome(status, written, check, aside["rows"], malformed, published)

"""Entity resolution: exact merge, e-mail merge, probable matches, ghosts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rillweave.config import DEFAULT, IntegrationConfig
from rillweave.operators.email_merge import email_merge
from rillweave.operators.fuzzy import (
    cell_links,
    flag_probable,
    fuzzy_pairs,
    name_cells,
    review_links,
    review_records,
    similar_cells,
)
from rillweave.operators.ghosts import ghosts
from rillweave.operators.survivorship import exact_merge
from rillweave.plans.staging import Staging


@dataclass(frozen=True)
class Resolution:
    """``match_links`` and ``match_records`` are the review list in short, ``probable_matches`` all pairs of records."""

    golden: DataFrame
    ghosts: DataFrame
    match_links: DataFrame
    match_records: DataFrame
    list_pairs: Callable[[], DataFrame]

    @property
    def probable_matches(self) -> DataFrame:
        """Planned when asked for: the plan counts what there is to compare."""
        return self.list_pairs()


def exact(records: DataFrame, config: IntegrationConfig = DEFAULT) -> DataFrame:
    return exact_merge(records, "employee_id", config.source_priority, config.null_sentinels)


def merged(records: DataFrame, stage: Staging, config: IntegrationConfig = DEFAULT) -> DataFrame:
    """Exact merge, written once, then the e-mail merge, which reads it several times."""
    staged = stage(exact(records, config), "exact")
    return email_merge(staged, config.source_priority, config.skew)


def probable_matches(survivors: DataFrame, stage: Staging, config: IntegrationConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(cells, similar cells) of the survivors, each written once."""
    cells = stage(name_cells(survivors, config.date_window_days), "cells")
    similar = stage(similar_cells(cells, config.fuzzy_threshold, config.skew), "similar")
    return cells, similar


def resolve(records: DataFrame, stage: Staging, config: IntegrationConfig = DEFAULT) -> Resolution:
    """Golden records with flags, ghosts and the pairs for review, from cleaned records."""
    survivors = stage(merged(records, stage, config), "merged")
    cells, similar = probable_matches(survivors, stage, config)
    days, policy = config.date_window_days, config.skew
    links = review_links(survivors, cells, similar, days)
    return Resolution(
        golden=flag_probable(survivors, cells, similar, days, policy),
        ghosts=ghosts(survivors),
        match_links=links,
        match_records=review_records(survivors, links, days),
        list_pairs=lambda: fuzzy_pairs(survivors, cells, cell_links(cells, similar), days, policy),
    )

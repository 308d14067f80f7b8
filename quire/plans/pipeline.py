"""The whole path from pages to chunks, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assets, blocks, chunking, cleanup, headings, sections


@dataclass
class Papers:
    """Knobs of the path; each step can also be called by itself.

    ``level`` names the column the chunker reads: ``assigned_level`` from the page-reset
    levels, or ``level`` from weak headings.
    """

    token_limit: int = 350
    margin: float = 0.1
    level: str = "assigned_level"

    def blocks(self, pages: DataFrame) -> DataFrame:
        return pages.transform(blocks.parse_pages).transform(blocks.promote_title).transform(cleanup.clean)

    def sections(self, cleaned: DataFrame, files: DataFrame | None = None) -> DataFrame:
        shown = assets.join_assets(cleaned, files).drop("matched") if files is not None else cleaned
        return sections.split_sections(shown)

    def leveled(self, split: DataFrame) -> DataFrame:
        if self.level == "assigned_level":
            return headings.page_reset_levels(split)
        return headings.weak_levels(split)

    def chunks(self, leveled: DataFrame, tokens: F.Column | None = None) -> DataFrame:
        count = tokens if tokens is not None else F.regexp_count("content", F.lit(r"(?U)\w+|[^\s\w]"))
        return chunking.build_chunks(leveled.withColumn("tok", count), self.token_limit, self.margin, self.level)

    def run(self, pages: DataFrame, files: DataFrame | None = None) -> DataFrame:
        return self.chunks(self.leveled(self.sections(self.blocks(pages), files)))

"""The five entities, their thirteen tables, and the job that writes them."""

from scholarlake.plans.entities import ENTITIES, TABLES, entity_table, malformed_lines
from scholarlake.plans.job import RunReport, run

__all__ = ["ENTITIES", "TABLES", "RunReport", "entity_table", "malformed_lines", "run"]

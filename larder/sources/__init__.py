"""Input tables: their schemas, binding to a catalog or files, and staging."""

from larder.sources.schemas import SOURCE_SCHEMAS, WEEK
from larder.sources.staging import new_path, release, scope, stage, stage_parts, unstage
from larder.sources.tables import Tables, conform, read_tables

__all__ = ["SOURCE_SCHEMAS", "WEEK", "Tables", "conform", "new_path", "read_tables", "release", "scope", "stage", "stage_parts", "unstage"]

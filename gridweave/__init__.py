"""gridweave: document tables, text grids and their assembly on Spark."""

from .operators.assembly import documents as assemble_documents
from .operators.assembly import matches
from .operators.grids import grid_tables
from .operators.markdown import blocks, cells, lines, parsed
from .plans.jobs import cascade, classic, classify, unified
from .sources.backends import Backend, ExtractionError, ModelOptions

__version__ = "0.1.0"

__all__ = ["Backend", "ExtractionError", "ModelOptions", "assemble_documents", "blocks", "cascade", "cells", "classic", "classify", "grid_tables", "lines", "matches", "parsed", "unified"]

"""python -m gridweave.plans.cli COMMAND: documents to text, workbooks, CSV and Word files.

    smart    Markdown (or PDF files, with a document model plugged in) and raw grids, put together; exit code 2 if documents with table pages gave no table
    classic  Markdown only: parse and export
    grids    raw grids to workbooks, CSV and previews
    pages    recognition results (JSON lines doc_id, page_no, page_result) to the same
    answers  a vision model's answers (JSON lines doc_id, page_no, response) to the same

Without a command, smart. Exit code 1 is an input that can't be read.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import sys
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleanup import corrected_table, load_corrections
from ..functions.corrections import CORRECTIONS
from ..operators.responses import with_tables
from ..sources import pages, readers, writers
from ..sources.backends import ExtractionError, ModelOptions, grid_backend, html_backend, numbered, skips_model
from .jobs import Options, cascade, classic, exit_code, routed

#: Loggers that say more than a user wants (fixed values).
NOISY = ("py4j", "pyspark")
COMMANDS = ("smart", "classic", "grids", "pages", "answers")
_GRIDS = "doc_id long, page_no int, index_on_page int, rows array<array<string>>"


def configure_logging(verbose: bool = False) -> None:
    logging.basicConfig(level=logging.DEBUG if verbose else logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    for name in NOISY:
        logging.getLogger(name).setLevel(logging.WARNING)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    argv = list(sys.argv[1:] if argv is None else argv)
    command = argv.pop(0) if argv and argv[0] in COMMANDS else "smart"
    p = argparse.ArgumentParser(prog=f"gridweave {command}", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.set_defaults(command=command)
    p.add_argument("-i", "--input", required=True, help="folder or file to read")
    p.add_argument("-o", "--output", default="output", help="folder for results, which all machines share")
    p.add_argument("-v", "--verbose", action="store_true")
    if command in ("smart", "grids"):
        p.add_argument("--no-header-row", action="store_true", help="a grid's first row is data")
    if command == "smart":
        p.add_argument("--grids", help="JSON lines with raw grids (doc_id, page_no, index_on_page, rows)")
        p.add_argument("--answers", help="JSON lines with a vision model's answers (doc_id, page_no, response)")
        p.add_argument("--corrections", help="JSON object of wrong and right texts, instead of the known ones")
        p.add_argument("--docx", action="store_true")
        p.add_argument("--skip-tables", action="store_true")
        which = p.add_mutually_exclusive_group()
        which.add_argument("--skip-marker", action="store_true", default=None, help="use the text layer instead of a document model")
        which.add_argument("--force-marker", action="store_true", default=None, help="use the document model whatever the environment says")
        p.add_argument("--converter", help="module:function of a document model, called with a file's path and bytes")
        p.add_argument("--vlm-model", default=ModelOptions.model, help="the model that gave the answers")
    if command == "classic":
        p.add_argument("--no-markdown", action="store_true", help="don't write the Markdown beside the results")
    if command == "answers":
        p.add_argument("--model", default=ModelOptions.model)
        p.add_argument("--dpi", type=int, default=ModelOptions.dpi)
        p.add_argument("--max-new-tokens", type=int, default=ModelOptions.max_new_tokens)
        p.add_argument("--temperature", type=float, default=ModelOptions.temperature)
        p.add_argument("--no-ocr-cleanup", action="store_true")
    if command in ("grids", "pages", "answers"):
        p.add_argument("--debug-tables", action="store_true", help="say how many tables each page gave")
    return p.parse_args(argv)


def plugged(name: str) -> Callable:
    """The function that module:function names."""
    module, _, function = name.partition(":")
    try:
        return getattr(importlib.import_module(module), function)
    except (ImportError, AttributeError) as e:
        raise ExtractionError(f"no such function: {name}") from e


def _json(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path) if path else spark.createDataFrame([], schema)


def _documents(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """(doc_id, text): Markdown files, and what the document model or the text beside them (.txt) gives for PDF files."""
    own = readers.texts(spark, a.input).select("doc_id", "text")
    if a.converter is None:
        return own
    files = readers.documents(spark, a.input)
    layer = readers.texts(spark, a.input, "*.txt").select(F.xxhash64(F.regexp_replace("path", r"\.txt$", ".pdf")).alias("doc_id"), "text")
    return own.unionByName(pages.markdown(files, plugged(a.converter), layer, skips_model(a.skip_marker, a.force_marker)).select("doc_id", "text"))


def _smart(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = _documents(spark, a).persist()
    grids, answers = _json(spark, a.grids, _GRIDS), _json(spark, a.answers, "doc_id long, page_no int, response string")
    model = numbered(with_tables(answers)).withColumn("backend", F.lit("vlm"))
    flagged = grids.where(F.size("rows") > 0).select("doc_id", "page_no").union(answers.select("doc_id", "page_no")).distinct()

    def tables(own: DataFrame) -> DataFrame:
        by_model = model.join(own.select("doc_id"), "doc_id", "left_semi")
        rest = grids.join(own.select("doc_id"), "doc_id", "left_semi").join(by_model.select("doc_id").distinct(), "doc_id", "left_anti")
        first = by_model.groupBy("doc_id", "backend").agg(F.array_sort(F.collect_list(F.struct("page_no", "index_on_page", "table"))).alias("t")).select("doc_id", "backend", F.posexplode("t").alias("table_no", "t")).select("doc_id", "backend", "table_no", "t.table")
        return first.unionByName(cascade(rest, [grid_backend(not a.no_header_row)]))

    pairs = load_corrections(a.corrections) if a.corrections else CORRECTIONS
    results = routed(docs, flagged, tables, pairs, Options(a.skip_tables)).persist()
    try:
        files = writers.text_files(results).unionByName(writers.table_exports(results, markdown=False))
        writers.save(files.unionByName(writers.word_documents(results)) if a.docx else files, a.output)
        return exit_code(results)
    finally:
        results.unpersist()
        docs.unpersist()


def _classic(spark: SparkSession, a: argparse.Namespace) -> int:
    results = classic(readers.texts(spark, a.input)).persist()
    try:
        files = writers.text_files(results).unionByName(writers.table_exports(results, markdown=False))
        writers.save(files if a.no_markdown else files.unionByName(writers.markdown_files(results)), a.output)
        return 0
    finally:
        results.unpersist()


def _tables(spark: SparkSession, a: argparse.Namespace) -> int:
    """Standalone extraction of all pages, with exports."""
    if a.command == "grids":
        found = cascade(_json(spark, a.input, _GRIDS), [grid_backend(not a.no_header_row)])
    elif a.command == "pages":
        found = cascade(_json(spark, a.input, "doc_id long, page_no int, page_result string"), [html_backend()])
    else:
        own = numbered(with_tables(_json(spark, a.input, "doc_id long, page_no int, response string")))
        own = own if a.no_ocr_cleanup else own.withColumn("table", corrected_table(F.col("table"), CORRECTIONS))
        found = own.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "index_on_page", "table"))).alias("t")).select("doc_id", F.posexplode("t").alias("table_no", "t")).select("doc_id", "table_no", "t.table")
    docs = found.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("table_no", "table"))), lambda x: x["table"]).alias("tables")).persist()
    try:
        if a.debug_tables:
            for r in docs.select("doc_id", F.size("tables").alias("n")).orderBy("doc_id").limit(1000).toLocalIterator():
                logging.getLogger(__name__).info("document %s: %s tables", r.doc_id, r.n)
        writers.export_tables(docs, a.output)
        return 0
    finally:
        docs.unpersist()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = arguments(argv)
    configure_logging(a.verbose)
    spark = spark or SparkSession.builder.appName("gridweave").getOrCreate()
    try:
        return {"smart": _smart, "classic": _classic}.get(a.command, _tables)(spark, a)
    except (ExtractionError, PySparkException, OSError) as e:
        logging.getLogger(__name__).error("%s", str(e).splitlines()[0] if str(e) else type(e).__name__)
        return 1


def route_and_extract(spark: SparkSession, source: str, output: str = ".", **options: str | bool) -> int:
    """The smart job in one call: route_and_extract(spark, "in", "out", docx=True); options are the command line's."""
    argv = ["smart", "-i", source, "-o", output]
    for name, value in options.items():
        argv += [f"--{name.replace('_', '-')}"] * bool(value) + ([str(value)] if value and value is not True else [])
    return main(argv, spark)


if __name__ == "__main__":
    raise SystemExit(main())

"""End-to-end analysis plan over one input folder.

``Analysis`` wires the operators in the order of the analysed tool (schema pass, barrier, link
pass; client pass; application-level linking) and materialises each stage once with a reliable
checkpoint (``cut``), so every registered query is a cheap projection of shared, already computed
tables and no plan grows without bound. Stages are built lazily on first use.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import materialize as M
from ..functions.patterns import PatternSet
from ..functions.text import mask_source
from ..operators import client as C
from ..operators import link as L
from ..operators import report as A
from ..operators import resolve as R
from ..operators import schema as S
from ..operators.extend import HandlerRegistry
from ..sources import corpus as K
from ..sources.files import file_line_counts, scan_checked, to_lines

#: Extensions of client sources.
CLIENT_EXTENSIONS = ["js", "jsx", "ts", "tsx"]


class Analysis:
    """Either over the generated corpora of a star-table folder (``sf_dir``), or over explicit
    inputs: ``schema_files`` / ``client_files`` as files(path, content) and ``kb`` as
    kb_objects(obj_id, type, name, fullname, annotations)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, *, schema_files: DataFrame | None = None,
                 client_files: DataFrame | None = None, kb: DataFrame | None = None, materialize: bool = True,
                 strict_case: bool = False, mask_first: bool = False, root_fields_exact: bool = False,
                 patterns: PatternSet | None = None, handlers: HandlerRegistry | None = None, errors: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}
        self._lock = threading.RLock()
        self._materialize = materialize
        self._given: DataFrame | None = None
        # D2 option: case-sensitive patterns; D9 option: mask strings/comments before parsing
        self.patterns = patterns or PatternSet(case_insensitive=not strict_case)
        self.handlers = handlers  # U1, U2
        self._errors = errors
        if mask_first and schema_files is None:
            raise ValueError("mask_first needs schema_files: generated lines are not masked")
        self.root_fields_exact = root_fields_exact  # D14 option: all fields of the outermost selection set
        if schema_files is not None and mask_first:
            schema_files = schema_files.withColumn("content", mask_source(F.col("content")))
        if schema_files is not None:  # split once, whoever reads the lines
            self._cache["schema_files"] = file_line_counts(schema_files)
            self._given = schema_files
        if client_files is not None:
            self._cache["client_files_all"] = client_files
        if kb is not None:
            self._cache["kb_objects"] = kb

    @classmethod
    def from_folders(cls, spark: SparkSession, schema_root: str, client_root: str | None = None, kb: DataFrame | None = None,
                     client_extensions: list[str] | None = None, max_bytes: int = 64 << 20, **options) -> Analysis:
        """S1-S4 and on: an analysis of the files under these folders. Files that cannot be read, or are too long for a row,
        are rows of ``errors()``; the others are analysed."""
        schema, errors = scan_checked(spark, schema_root, max_bytes=max_bytes)
        client = None
        if client_root is not None:
            client, more = scan_checked(spark, client_root, client_extensions or CLIENT_EXTENSIONS, max_bytes)
            errors = errors.unionByName(more)
        return cls(spark, schema_files=schema, client_files=client, kb=kb, errors=errors, **options)

    def errors(self) -> DataFrame:
        """A1: path, stage, error of every file or handler that failed."""
        none = self.spark.createDataFrame([], "path string, stage string, error string")
        found = none if self._errors is None else self._errors
        if self.handlers is not None:
            failed = self.handler_outcomes().filter("error is not null")
            found = found.unionByName(failed.select(F.lit(None).cast("string").alias("path"), F.concat(F.lit("handler "), "handler").alias("stage"), "error"))
        return found

    def _handled(self) -> tuple[DataFrame | None, DataFrame]:
        return self._get("handled", lambda: self.handlers.run(self.nodes()))

    def handled(self) -> DataFrame | None:
        """The rows of the handlers that ran."""
        return self._handled()[0]

    def handler_outcomes(self) -> DataFrame:
        return self._handled()[1]

    def report_totals(self) -> DataFrame:
        """A1: files, objects, links and errors."""
        return A.report_totals(self.schema_input()[1], self.objects(), self.schema_links(), self.errors())

    def _cut(self, df: DataFrame, name: str = "stage") -> DataFrame:
        return M.cut(df, name) if self._materialize else M.persist(df)

    def _get(self, key: str, build) -> DataFrame:
        with self._lock:
            if key not in self._cache:
                self._cache[key] = build()
            return self._cache[key]

    # ---------------------------------------------------------------- inputs
    def schema_input(self) -> tuple[DataFrame, DataFrame]:
        def build():
            if self._given is not None:
                return self._cut(to_lines(self._given), "schema-lines")
            return self._cut(self._schema_corpus()[0])
        lines = self._get("schema_lines", build)
        files = self._get("schema_files", lambda: self._cut(self._schema_corpus()[1]))
        return lines, files

    def _schema_corpus(self) -> tuple[DataFrame, DataFrame]:
        return self._get("schema_corpus", lambda: K.schema_corpus(self.spark, self.sf_dir))

    def client_input(self) -> DataFrame:
        return self._get("client_files_all", lambda: self._cut(K.client_corpus(self.spark, self.sf_dir)))

    def backend(self) -> DataFrame:
        return self._get("kb_objects", lambda: self._cut(K.backend_catalogue(self.spark, self.sf_dir)))

    # ---------------------------------------------------------------- schema pass
    def _extract(self) -> dict[str, DataFrame]:
        def build():
            lines, files = self.schema_input()
            r = S.extract_objects(lines, files, self.patterns)
            slim = r["nodes"]
            if not self._materialize:
                return {"objects": M.persist(r["objects"]), "nodes": M.persist(slim)}
            objs, nodes = M.cut_many([(r["objects"], "objects"), (slim, "nodes")])
            return {"objects": objs, "nodes": nodes}
        with self._lock:
            if "extract" not in self._cache:
                self._cache["extract"] = build()
            return self._cache["extract"]

    def objects(self) -> DataFrame:
        return self._extract()["objects"]

    def nodes(self) -> DataFrame:
        return self._extract()["nodes"]

    # ---------------------------------------------------------------- link pass
    def references(self) -> DataFrame:
        def build():
            refs = R.type_references(self.schema_input()[0])
            refs = R.reference_callers(refs, self.nodes())
            return self._cut(R.resolve_references(refs, self.objects()))
        return self._get("references", build)

    def schema_links(self) -> DataFrame:
        return R.schema_links(self.references())

    # ---------------------------------------------------------------- client pass
    def client_files(self) -> DataFrame:
        return self._get("client_files", lambda: self._cut(C.client_files(self.client_input())))

    def client_events(self) -> DataFrame:
        return self._get("client_events", lambda: C.client_events(self.client_files()))

    def definitions(self) -> DataFrame:
        return self._get("definitions", lambda: self._cut(C.client_definitions(self.client_files(), self.client_events(), self.root_fields_exact)))

    def requests(self) -> DataFrame:
        def build():
            reqs = C.requests(self.client_files(), self.client_events())
            return self._cut(C.definition_lookup(reqs, self.definitions()))
        return self._get("requests", build)

    def client_links(self) -> DataFrame:
        return C.client_links(self.requests())

    # ---------------------------------------------------------------- application level
    def schema_index(self) -> DataFrame:
        return self._get("schema_index", lambda: self._cut(L.schema_index(self.objects())))

    def definition_field_links(self) -> DataFrame:
        return self._get("def_field_links", lambda: self._cut(L.definition_field_links(self.definitions(), self.schema_index())))

    def method_matches(self) -> DataFrame:
        return self._get("method_matches", lambda: self._cut(L.match_methods(self.backend(), self.schema_index())))

    def field_method_links(self) -> DataFrame:
        return L.field_method_links(self.method_matches())

    def import_lines(self) -> DataFrame:
        return self._get("import_lines", lambda: self._cut(K.import_corpus(self.spark, self.sf_dir)))

    def keyword_blocks(self) -> tuple[DataFrame, DataFrame]:
        """(lines, nodes) of the keyword-block corpus classified with the keyword pattern set."""
        from ..functions.patterns import KEYWORD_BLOCK_PATTERNS
        lines = self._get("kw_lines", lambda: self._cut(K.keyword_block_corpus(self.spark, self.sf_dir)))
        nodes = self._get("kw_nodes", lambda: self._cut(
            S.classify(lines, KEYWORD_BLOCK_PATTERNS).filter(F.col("pattern_key").isNotNull())
            .select("path", "line", "pattern_key", "name", "expected_parent")))
        return lines, nodes

    def all_links(self) -> DataFrame:
        cols = ["link_type", "caller", "callee"]
        return self.schema_links().select(*cols).unionByName(self.client_links().select(*cols)) \
            .unionByName(self.definition_field_links().select(*cols)) \
            .unionByName(self.field_method_links().select(*cols))



_REGISTRY: dict[tuple[str, str], Analysis] = {}
_REG_LOCK = threading.Lock()


def analysis_for(spark: SparkSession, sf_dir: str) -> Analysis:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _REG_LOCK:
        if key not in _REGISTRY:
            _REGISTRY[key] = Analysis(spark, sf_dir.rstrip("/"))
        return _REGISTRY[key]

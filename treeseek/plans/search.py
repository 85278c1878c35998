"""The query builder. Immutable: every call returns a new query.

Nothing runs before an action on one of the resulting DataFrames, with two
exceptions: more-like-this first fetches the few terms it searches for, and a
page with highlights is fetched before its text is looked up.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeseek.errors import QueryError
from treeseek.functions.html import BUCKETS
from treeseek.functions.paths import subtree, value_at
from treeseek.model import (
    DEFAULT_PAGE,
    FIELD_BOOSTS,
    HIGHLIGHT_COUNT,
    HIGHLIGHT_NO_MATCH,
    HIGHLIGHT_SIZE,
    LIVE,
)
from treeseek.operators import filters, function_score, ordering, relevance, similar
from treeseek.operators import suggest as suggestions_
from treeseek.operators.aggregate import Aggregations
from treeseek.operators.highlight import highlight_columns
from treeseek.operators.overlay import chain, first_hit, overlay
from treeseek.operators.relevance import DOCUMENT, TextQuery
from treeseek.operators.text_index import TextIndex, restrict
from treeseek.session import materialise

DEFAULT_SELECT = ("path", "node_id")
_FETCHED_PAGE = 1_000


@dataclass(frozen=True)
class SearchIndex:
    """What a query runs on: documents, their text index, the workspace chain."""

    docs: DataFrame
    text: TextIndex | None = None
    workspaces: Mapping[str, str | None] = field(default_factory=lambda: {LIVE: None})
    boosts: Mapping[str, float] = field(default_factory=lambda: dict(FIELD_BOOSTS))


@dataclass(frozen=True)
class Search:
    """A query under construction. Start with ``Search(index)``."""

    index: SearchIndex
    dimensions: tuple[str, ...] | None = None
    chain: tuple[str, ...] | None = None
    overlay_mode: str = "exact"
    must: tuple[Column, ...] = ()
    should: tuple[Column, ...] = ()
    must_not: tuple[Column, ...] = ()
    filter_: tuple[Column, ...] = ()
    min_should: int | None = None
    show_hidden: bool = False
    text_query: tuple[str, str, str] | None = None
    text_boosts: Mapping[str, float] | None = None
    like: tuple | None = None
    highlights: tuple[tuple[str, int, int | None, int], ...] = ()
    score_functions: tuple[Mapping, ...] = ()
    score_options: Mapping[str, object] = field(default_factory=dict)
    aggregations_: Aggregations = Aggregations()
    suggestions_: Mapping[str, Mapping] = field(default_factory=dict)
    sort_keys: tuple[ordering.SortKey, ...] = ()
    limit_: int | None = DEFAULT_PAGE
    offset_: int | None = None
    columns: tuple[str, ...] | None = DEFAULT_SELECT
    steps: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    # Context

    def query(self, node: object, workspace: str = LIVE, dimension: str | None = None) -> Search:
        """Search below a node, itself included, as its workspace and dimension show it.

        ``node`` is its path, or a row or mapping with ``path``, ``workspace``
        and ``dimension``.
        """
        path = node
        if not isinstance(node, str):
            given = node.asDict() if hasattr(node, "asDict") else dict(node)
            path, workspace = given["path"], given.get("workspace", workspace)
            dimension = given.get("dimension", dimension)
        found = self.where(subtree(F.col("path"), path)).in_workspace(workspace)
        return found.in_dimension(dimension) if dimension is not None else found

    def in_workspace(self, workspace: str, overlay_mode: str = "exact") -> Search:
        """``exact`` hides every replaced base row; ``first_hit`` only drops double hits."""
        if overlay_mode not in ("exact", "first_hit"):
            raise QueryError(f"unknown overlay mode {overlay_mode!r}")
        names = tuple(chain(dict(self.index.workspaces), workspace))
        return replace(self, chain=names, overlay_mode=overlay_mode)

    def in_dimension(self, *dimensions: str) -> Search:
        return replace(self, dimensions=dimensions or None)

    # Filters

    def _clause(self, condition: Column, clause: str) -> Search:
        if clause not in filters.CLAUSES:
            raise QueryError(f"unknown clause {clause!r}, expected one of {filters.CLAUSES}")
        name = "filter_" if clause == "filter" else clause
        return replace(self, **{name: (*getattr(self, name), condition)})

    def where(self, condition: Column, clause: str = "must") -> Search:
        return self._clause(condition, clause)

    def node_type(self, name: str) -> Search:
        return self._clause(F.array_contains("type_closure", name), "must")

    def exact_match(self, name: str, value: object) -> Search:
        return self._clause(filters.term(self.index.docs, name, value), "must")

    def exclude(self, name: str, value: object) -> Search:
        # Kept whole as a must clause: it is already null-safe and can be pushed down.
        return self._clause(filters.exclude(self.index.docs, name, value), "must")

    def greater_than(self, name: str, value: object, clause: str = "must") -> Search:
        return self._clause(filters.range_(self.index.docs, name, gt=value), clause)

    def greater_than_or_equal(self, name: str, value: object, clause: str = "must") -> Search:
        return self._clause(filters.range_(self.index.docs, name, gte=value), clause)

    def less_than(self, name: str, value: object, clause: str = "must") -> Search:
        return self._clause(filters.range_(self.index.docs, name, lt=value), clause)

    def less_than_or_equal(self, name: str, value: object, clause: str = "must") -> Search:
        return self._clause(filters.range_(self.index.docs, name, lte=value), clause)

    def prefix(self, name: str, start: str, clause: str = "must") -> Search:
        return self._clause(filters.prefix(self.index.docs, name, start), clause)

    def geo_distance(self, name: str, point: object, distance: str | float, clause: str = "must") -> Search:
        return self._clause(filters.geo_distance(self.index.docs, name, point, distance), clause)

    def query_filter(self, kind: str, options: object, clause: str = "must") -> Search:
        if kind == "more_like_this":
            rest = {k: v for k, v in options.items() if k not in ("like", "fields")}
            return self.more_like_this(options["like"], options.get("fields", ()), **rest)
        if kind in ("query_string", "simple_query_string"):
            if clause not in ("must", "filter"):
                raise QueryError(f"{kind} can only be a must or filter clause")
            rest = {k: v for k, v in options.items() if k != "query"}
            method = self.fulltext if kind == "query_string" else self.simple_fulltext
            return method(options["query"], **rest)
        return self._clause(filters.clause(self.index.docs, kind, options), clause)

    def query_filter_multiple(self, wanted: Mapping[str, object], clause: str = "must") -> Search:
        result = self
        for condition in filters.filter_map(self.index.docs, wanted):
            result = result._clause(condition, clause)
        return result

    def minimum_should_match(self, n: int) -> Search:
        return replace(self, min_should=n)

    def include_hidden(self) -> Search:
        return replace(self, show_hidden=True)

    def transform(self, step: Callable[[DataFrame], DataFrame]) -> Search:
        """An own step over the matching documents."""
        return replace(self, steps=(*self.steps, step))

    # Full text

    def _words(self) -> TextQuery | None:
        """The query in the terms of the dimensions that are searched, whichever were asked for first or last."""
        if self.text_query is None:
            return None
        if self.index.text is None:
            raise QueryError("this index has no full text")
        kind, words, operator = self.text_query
        return getattr(TextQuery, kind)(words, self.index.text.analyzers, operator, self.dimensions)

    def _text(self, kind: str, words: str, operator: str, fields: object) -> Search:
        if self.index.text is None:
            raise QueryError("this index has no full text")
        getattr(TextQuery, kind)(words, None, operator)  # an unknown operator is told at once
        query = (kind, words, operator)
        boosts = None
        if fields is not None:
            named = fields.items() if isinstance(fields, Mapping) else (f.partition("^")[::2] for f in fields)
            boosts = {n.removeprefix("fulltext."): float(b or 1.0) for n, b in named}
        return replace(self, text_query=query, text_boosts=boosts).highlight(HIGHLIGHT_SIZE, HIGHLIGHT_COUNT)

    def fulltext(self, words: str, default_operator: str = "or", fields: object = None) -> Search:
        """Documents with the words, ranked, with highlights."""
        return self._text("words", words, default_operator, fields)

    def simple_fulltext(self, words: str, default_operator: str = "or", fields: object = None) -> Search:
        """As :meth:`fulltext`, with phrases, prefixes and signs; what is broken is ignored."""
        return self._text("simple", words, default_operator, fields)

    def highlight(
        self,
        size: int | bool,
        count: int | None = None,
        no_match_size: int = HIGHLIGHT_NO_MATCH,
        field: str = "fulltext.*",
    ) -> Search:
        """Highlights of one bucket or of all; ``False`` clears them."""
        if size is False:
            return replace(self, highlights=())
        name = field.removeprefix("fulltext.")
        names = BUCKETS if name == "*" else (name,)
        if any(n not in BUCKETS for n in names):
            raise QueryError(f"unknown full-text bucket {name!r}")
        kept = tuple(h for h in self.highlights if h[0] not in names)
        return replace(self, highlights=(*kept, *[(n, int(size), count, no_match_size) for n in names]))

    def more_like_this(self, like: object, fields: Sequence[str] = (), **options: object) -> Search:
        """Documents like the given texts or nodes; nothing to compare with means no clause."""
        items = list(like) if isinstance(like, (list, tuple)) else [like]
        items = [i for i in items if i]
        if not items:
            return self
        names = tuple(f.removeprefix("fulltext.") for f in fields) or tuple(self.index.boosts)
        return replace(self, like=(tuple(items), names, dict(options)))

    def term_suggestions(self, text: str, field: str = "fulltext.text", name: str = "suggestions") -> Search:
        return self.suggestions(name, {"text": text, "term": {"field": field}})

    def suggestions(self, name: str, definition: Mapping) -> Search:
        suggestions_.definition(definition)
        return replace(self, suggestions_={**self.suggestions_, name: definition})

    # Score functions

    def functions(self, specs: Sequence[Mapping]) -> Search:
        return replace(self, score_functions=tuple(specs))

    def _score_option(self, name: str, value: object, allowed: Sequence[str] | None = None) -> Search:
        if allowed is not None and value not in allowed:
            raise QueryError(f"unknown {name} {value!r}, expected one of {allowed}")
        return replace(self, score_options={**self.score_options, name: value})

    def score_mode(self, mode: str) -> Search:
        return self._score_option("score_mode", mode, function_score.SCORE_MODES)

    def boost_mode(self, mode: str) -> Search:
        return self._score_option("boost_mode", mode, function_score.BOOST_MODES)

    def max_boost(self, value: float) -> Search:
        return self._score_option("max_boost", value)

    def min_score(self, value: float) -> Search:
        return self._score_option("min_score", value)

    # Aggregations

    def field_based_aggregation(
        self, name: str, field: str, type: str = "terms", parent_path: str = "", size: int | None = None
    ) -> Search:
        spec = {"field": field} if size is None else {"field": field, "size": size}
        return self.aggregation(name, {type: spec}, parent_path)

    def aggregation(self, name: str, definition: Mapping, parent_path: str = "") -> Search:
        return replace(self, aggregations_=self.aggregations_.add(name, definition, parent_path))

    # Order and page

    def sort_asc(self, name: str) -> Search:
        return replace(self, sort_keys=(*self.sort_keys, ordering.SortKey(name)))

    def sort_desc(self, name: str) -> Search:
        return replace(self, sort_keys=(*self.sort_keys, ordering.SortKey(name, True)))

    def sort(self, configuration: object) -> Search:
        return replace(self, sort_keys=(*self.sort_keys, *ordering.parse(configuration)))

    def limit(self, n: int | None, all: bool = False) -> Search:
        """Null is ignored; ``all=True`` asks for every hit."""
        if all:
            return replace(self, limit_=None)
        if n is None:
            return self
        if n < 1:
            raise QueryError("the limit must be at least 1")
        return replace(self, limit_=int(n))

    def from_(self, n: int | None) -> Search:
        """Null and 0 are ignored."""
        return replace(self, offset_=int(n)) if n else self

    def select(self, *columns: str) -> Search:
        """Columns of a hit; none means all of them."""
        return replace(self, columns=columns or None)

    # Results

    def _like_documents(self, docs: DataFrame) -> DataFrame:
        items, fields, options = self.like
        text = self._scoped_text()
        strings = [i for i in items if isinstance(i, str)]
        nodes = [i["node_id"] if isinstance(i, Mapping) else i.node_id for i in items if not isinstance(i, str)]
        counts, exclude = None, None
        if strings:
            counts = similar.terms_of_strings(text, strings, fields, self.dimensions)
        if nodes:
            # Looked up among the documents this query would see.
            known = docs.where(F.col("node_id").isin(nodes))
            exclude = known.select(*DOCUMENT)
            found = similar.terms_of_documents(text, known, fields)
            both = found if counts is None else counts.unionByName(found)
            counts = both.groupBy("field", "term").agg(F.sum("tf").alias("tf"))
        matches = similar.more_like_this(text, counts, exclude, **options)
        return docs.join(matches.select(*DOCUMENT), list(DOCUMENT), "left_semi")

    def _scoped_text(self) -> TextIndex:
        if self.index.text is None:
            raise QueryError("this index has no full text")
        text = self.index.text
        if self.chain:
            # Statistics stay those of the whole index.
            text = replace(text, postings=text.postings.where(F.col("workspace").isin(list(self.chain))))
        if not self.dimensions:
            return text
        return restrict(text, self.dimensions)

    def condition(self) -> Column:
        """All filter clauses as one Column."""
        excluded = [*self.must_not]
        combined = filters.combine(self.must, self.filter_, self.should, excluded, self.min_should)
        if not self.show_hidden and "hidden" in self.index.docs.columns:
            combined = combined & filters.not_hidden()
        return combined

    def matching(self, functions: bool = True) -> DataFrame:
        """All matching documents with their score, before order and paging."""
        docs = self.index.docs
        if self.dimensions:
            docs = docs.where(F.col("dimension").isin(list(self.dimensions)))
        if self.chain and self.overlay_mode == "exact":
            docs = overlay(docs, self.chain)
        elif self.chain:
            docs = docs.where(F.col("workspace").isin(list(self.chain)))
        if "deleted" in docs.columns:
            docs = docs.where(~F.coalesce("deleted", F.lit(False)))
        docs = docs.where(self.condition())
        if self.like is not None:
            docs = self._like_documents(docs)
        if self.text_query is not None:
            boosts = self.text_boosts or self.index.boosts
            docs = relevance.attach(docs, self._scoped_text(), self._words(), boosts)
        else:
            docs = docs.withColumn("score", F.lit(1.0))
        if functions and self.score_functions:
            docs = function_score.apply(docs, self.score_functions, **self.score_options)
        if self.chain and self.overlay_mode == "first_hit" and len(self.chain) > 1:
            order = [k.order(k.value(docs)) for k in self.sort_keys] or [F.desc("score")]
            docs = first_hit(docs, self.chain, order)
        for step in self.steps:
            docs = step(docs)
        return docs

    def hits(self) -> DataFrame:
        """The page: asked columns, ``doc_id``, ``score``, ``sort_values``, ``highlight``."""
        found = self.matching()
        columns = [*(self.columns or [c for c in found.columns if c != "fulltext"])]
        if self.columns == DEFAULT_SELECT:
            columns = [c for c in columns if c in found.columns]
        if "score" not in columns:
            columns.append("score")
        held = self.index.docs.schema["fulltext"].dataType.fieldNames() if "fulltext" in self.index.docs.columns else ()
        marks = [h for h in self.highlights if h[0] in held] if self.text_query is not None else []
        added = [c for c in DOCUMENT if c not in columns and c != "doc_id"] if marks else []
        page, order = ordering.page(found, self.sort_keys, self.limit_, self.offset_, [*columns, *added])
        if marks:
            joined = self._with_text(page)
            page = joined.withColumn("highlight", highlight_columns(marks, self._words())).orderBy(*order)
            page = page.drop(*added, *(["fulltext"] if self.columns is not None else []))
        return page

    def _with_text(self, page: DataFrame) -> DataFrame:
        """The page with its full text, which never goes through the sort.

        It is joined by the whole key, so the result is the same for a page of
        any size. A short page is fetched first: literal ids and paths then keep
        the text of all other documents from being read.
        """
        docs = self.index.docs
        keys = list(DOCUMENT)
        if self.limit_ is None or self.limit_ > _FETCHED_PAGE:
            return page.join(docs.select(*keys, "fulltext"), keys, "left")
        rows = page.collect()
        found = docs.where(F.col("doc_id").isin([r.doc_id for r in rows]))
        if "path" in page.columns:
            found = found.where(F.col("path").isin([r.path for r in rows]))
        fetched = page.sparkSession.createDataFrame(rows, page.schema, verifySchema=False)
        return fetched.join(found.select(*keys, "fulltext"), keys, "left")

    def execute(self) -> SearchResult:
        return SearchResult(self)

    def count(self) -> int:
        """Matching documents; order, page, highlight and score functions do not matter."""
        return self.matching(functions=False).count()


@dataclass(frozen=True)
class SearchResult:
    search: Search

    def hits(self) -> DataFrame:
        return self.search.hits()

    def total(self) -> int:
        return self.search.matching().count()

    def first(self):
        rows = self.search.limit(1).hits().head(1)
        return rows[0] if rows else None

    def aggregations(self, share: bool = False) -> dict[str, DataFrame]:
        """A DataFrame per aggregation; ``share`` matches once for all of them.

        Buckets are then counted in one pass and written; with sketches among
        the aggregations, the few columns that they read are written instead.
        """
        asked = self.search.aggregations_
        if not asked.items:
            return {}
        matching = self.search.matching()
        if not share:
            return asked.compute(matching)
        if asked.countable:
            return asked.compute(matching, materialise(asked.counted(matching), "buckets"))
        return asked.compute(materialise(matching.select(*asked.fields), "matching"))

    def metrics(self) -> DataFrame | None:
        """The metrics without buckets, together in one row."""
        return self.search.aggregations_.metrics(self.search.matching())

    def suggestions(self) -> dict[str, DataFrame]:
        found = {}
        for name, definition in self.search.suggestions_.items():
            text, field_name, options = suggestions_.definition(definition)
            index = self.search._scoped_text()
            found[name] = suggestions_.suggest(
                index.term_stats, text, field_name, index.analyzers.pick(field_name=field_name), **options
            )
        return found

    def did_you_mean(self, threshold: float = 0.7, name: str = "suggestions") -> DataFrame:
        return suggestions_.did_you_mean(self.suggestions()[name], threshold)

    def hit_for_node(self, node_id: str, path: str | None = None) -> DataFrame:
        """The raw hit of a node, or the value at a dotted path in it."""
        search = self.search
        if search.limit_ is None and not search.offset_:
            # All hits: the node is picked before anything is put in order.
            search = search.transform(lambda docs: docs.where(F.col("node_id") == node_id))
        row = search.hits().where(F.col("node_id") == node_id)
        return row.select(value_at(row, path).alias("value"))

    def sort_values(self, node_id: str) -> DataFrame:
        return self.hit_for_node(node_id, "sort_values")

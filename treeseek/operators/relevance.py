"""Full-text matching and scoring on postings.

Score of a document: 1 for matching at all, plus the best field's weighted
BM25 sum. Scores are kept to six decimals, so that equal documents tie and the
document id decides.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeseek.errors import QueryError
from treeseek.functions.analysis import Analyzer, AnalyzerSet
from treeseek.model import FIELD_BOOSTS
from treeseek.operators.filters import conjunction, disjunction
from treeseek.operators.text_index import TextIndex

# BM25 parameters, and the decimals of a score.
K1, B = 1.2, 0.75
DECIMALS = 6

_WORD = re.compile(r'([+\-]?)(?:"([^"]*)"?|([^\s|"]+))|(\|)')


# What a document is told apart by: an id alone may be the same in several dimensions.
DOCUMENT = ("dimension", "workspace", "doc_id")


@dataclass(frozen=True)
class Scope:
    """Where an analyser is the one that counts: some fields, or some dimensions; the rest if ``others``."""

    column: str
    names: tuple[str, ...]
    others: bool = False
    # Fields with an analyser of their own do not follow the dimension.
    except_fields: tuple[str, ...] = ()

    def condition(self) -> Column:
        inside = F.col(self.column).isin(list(self.names))
        here = ~inside if self.others else inside
        return here & ~F.col("field").isin(list(self.except_fields)) if self.except_fields else here


@dataclass(frozen=True)
class Atom:
    """A word, a prefix or a phrase, as an analyser sees it where that one counts."""

    kind: str
    terms: tuple[str, ...]
    scope: Scope | None = None
    folded: bool = False


@dataclass(frozen=True)
class Clause:
    """Atoms of which one must match; required or excluded as a whole."""

    atoms: tuple[Atom, ...]
    mode: str = "optional"


@dataclass(frozen=True)
class TextQuery:
    clauses: tuple[Clause, ...] = field(default_factory=tuple)

    @property
    def positive(self) -> list[Clause]:
        return [c for c in self.clauses if c.mode != "excluded"]

    @property
    def atoms(self) -> list[Atom]:
        return list(dict.fromkeys(a for c in self.clauses for a in c.atoms))

    @property
    def scoring_atoms(self) -> list[Atom]:
        return list(dict.fromkeys(a for c in self.positive for a in c.atoms))

    @classmethod
    def words(
        cls,
        text: str,
        analyzer: Analyzer | AnalyzerSet | None = None,
        operator: str = "or",
        dimensions: Sequence[str] | None = None,
    ) -> TextQuery:
        """Plain words; a trailing ``*`` asks for a prefix."""
        return cls.simple(re.sub(r'["|]|(^|\s)[+\-]', " ", text), analyzer, operator, dimensions)

    @classmethod
    def simple(
        cls,
        text: str,
        analyzer: Analyzer | AnalyzerSet | None = None,
        operator: str = "or",
        dimensions: Sequence[str] | None = None,
    ) -> TextQuery:
        """Words, ``"phrases"``, ``prefix*``, ``+required``, ``-excluded``, ``a | b``.

        What makes no sense is left out: a stray sign, an empty phrase. Of a set
        of analysers each sees the words for the dimensions and fields it is
        for; ``dimensions`` are those that are searched, if not all.
        """
        if operator.lower() not in ("or", "and"):
            raise QueryError(f"operator must be or / and, not {operator!r}")
        scoped = _scopes(analyzer or Analyzer(), dimensions)
        default = "required" if operator.lower() == "and" else "optional"
        clauses: list[Clause] = []
        joining = False
        for sign, phrase, word, bar in _WORD.findall(text):
            if bar:
                joining = bool(clauses)
                continue
            places = _places(phrase, word, scoped)
            if not places:
                continue
            mode = {"+": "required", "-": "excluded"}.get(sign, default)
            if joining and clauses[-1].mode != "excluded":
                last = clauses.pop()
                clauses.append(Clause((*last.atoms, *[a for place in places for a in place]), last.mode))
            else:
                # One word that the analyser splits stays several clauses.
                clauses.extend(Clause(place, mode) for place in places)
            joining = False
        return cls(tuple(clauses))


def _atoms(phrase: str, word: str, analyzer: Analyzer) -> list[Atom]:
    if phrase:
        found = analyzer.terms(phrase)
        return [Atom("phrase" if len(found) > 1 else "word", tuple(found))] if found else []
    if word.endswith("*"):
        found = analyzer.terms(word[:-1])
        return [Atom("word", (t,)) for t in found[:-1]] + [Atom("prefix", (t,)) for t in found[-1:]]
    return [Atom("word", (t,)) for t in analyzer.terms(word)]


def _scopes(
    analyzer: Analyzer | AnalyzerSet, dimensions: Sequence[str] | None
) -> list[tuple[Scope | None, Analyzer]]:
    """Each analyser that can meet a stored text, and where."""
    if isinstance(analyzer, Analyzer):
        return [(None, analyzer)]
    own_fields = tuple(sorted(analyzer.by_field))
    found = [(Scope("field", (name,)), analyzer.by_field[name]) for name in own_fields]
    asked = [d for d in analyzer.by_dimension if dimensions is None or d in dimensions]
    found += [(Scope("dimension", (d,), except_fields=own_fields), analyzer.by_dimension[d]) for d in asked]
    if dimensions is None or set(dimensions) - set(asked):
        rest = Scope("dimension", tuple(analyzer.by_dimension), True, own_fields) if asked or own_fields else None
        found.append((rest, analyzer.default))
    return found


def _places(phrase: str, word: str, scoped: Sequence[tuple[Scope | None, Analyzer]]) -> list[tuple[Atom, ...]]:
    """The atoms of a word, place by place: at each, what every analyser has there."""
    seen = [
        [replace(a, scope=scope, folded=analyzer.fold) for a in _atoms(phrase, word, analyzer)]
        for scope, analyzer in scoped
    ]
    longest = max((len(atoms) for atoms in seen), default=0)
    # Where one analyser splits and another does not, the last piece of the shorter one stands for the rest.
    return [tuple(atoms[min(i, len(atoms) - 1)] for atoms in seen if atoms) for i in range(longest)]


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def saturation(tf: Column, dl: Column, avg_dl: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avg_dl))


def _same_term(atom: Atom) -> Column:
    term = F.col("term")
    same = term.startswith(atom.terms[0]) if atom.kind == "prefix" else term.isin(list(atom.terms))
    return same if atom.scope is None else same & atom.scope.condition()


def candidates(index: TextIndex, query: TextQuery, fields: Sequence[str]) -> DataFrame:
    """Postings of the query's terms, with the statistics of each exact term.

    The statistics are one row per (dimension, field, term of the query), so
    their size does not depend on the data. A term the statistics do not know
    yet counts as occurring in one document.
    """
    wanted = disjunction(_same_term(a) for a in query.atoms)
    in_fields = F.col("field").isin(list(fields))
    exact = sorted({t for a in query.atoms if a.kind != "prefix" for t in a.terms})
    postings = index.postings.where(in_fields & wanted)
    known = index.term_stats.where(in_fields & F.col("term").isin(exact))
    return (
        postings.join(F.broadcast(known), ["dimension", "field", "term"], "left")
        .join(F.broadcast(index.field_stats.where(in_fields)), ["dimension", "field"], "left")
        .withColumns(
            {
                "df": F.coalesce("df", F.lit(1)),
                "n_docs": F.coalesce("n_docs", F.lit(1)),
                "avg_dl": F.coalesce("avg_dl", F.col("dl").cast("double")),
            }
        )
    )


def _phrase_count(atom: Atom, name: str) -> Column:
    """How often the phrase occurs, from the positions of its terms."""
    def shifted(i: int) -> Column:
        return F.transform(F.col(f"{name}_{i}"), lambda p: p - i)

    places = [shifted(i) for i in range(len(atom.terms))]
    shared = reduce(F.array_intersect, places)
    return F.coalesce(F.size(shared), F.lit(0))


def score(
    index: TextIndex,
    query: TextQuery,
    boosts: Mapping[str, float] | None = None,
) -> DataFrame:
    """Rows (dimension, workspace, doc_id, score) of all documents that match the query.

    One aggregation by document; only postings of query terms reach it.
    """
    boosts = dict(FIELD_BOOSTS if boosts is None else boosts)
    if not query.positive:
        raise QueryError("a query with exclusions only has nothing to score; use matches_none")
    if not index.postings.columns:
        raise QueryError("no index")
    fields = list(boosts)
    rows = candidates(index, query, fields)
    weight = idf(F.col("n_docs"), F.col("df"))
    part = weight * saturation(F.col("tf"), F.col("dl"), F.col("avg_dl"))

    aggregates: list[Column] = []
    for position, atom in enumerate(query.atoms):
        for f, name in enumerate(fields):
            here, key = F.col("field") == name, f"a{position}_f{f}"
            if atom.kind == "word":
                aggregates.append(F.sum(F.when(here & _same_term(atom), part)).alias(key))
            elif atom.kind == "prefix":
                aggregates.append(F.max(F.when(here & _same_term(atom), F.lit(1.0))).alias(key))
            else:
                for i, term in enumerate(atom.terms):
                    hit = here & _same_term(atom) & (F.col("term") == term)
                    aggregates.append(F.max(F.when(hit, F.col("positions"))).alias(f"{key}_{i}"))
                any_term = here & _same_term(atom)
                aggregates.append(F.max(F.when(any_term, F.col("dl"))).alias(f"{key}_dl"))
                aggregates.append(F.max(F.when(any_term, F.col("avg_dl"))).alias(f"{key}_avg"))
                for i, term in enumerate(atom.terms):
                    hit = here & _same_term(atom) & (F.col("term") == term)
                    aggregates.append(F.max(F.when(hit, weight)).alias(f"{key}_idf{i}"))
    grouped = rows.groupBy(*DOCUMENT).agg(*aggregates)

    def value(atom: Atom, f: int) -> Column:
        key = f"a{query.atoms.index(atom)}_f{f}"
        if atom.kind != "phrase":
            return F.col(key)
        count = _phrase_count(atom, key)
        total = reduce(lambda a, b: a + b, [F.col(f"{key}_idf{i}") for i in range(len(atom.terms))])
        return F.when(count > 0, total * saturation(count, F.col(f"{key}_dl"), F.col(f"{key}_avg")))

    def matched(clause: Clause) -> Column:
        return disjunction(value(a, f).isNotNull() for a in clause.atoms for f in range(len(fields)))

    required = [matched(c) for c in query.clauses if c.mode == "required"]
    optional = [matched(c) for c in query.clauses if c.mode == "optional"]
    excluded = [~matched(c) for c in query.clauses if c.mode == "excluded"]
    condition = conjunction([*required, *excluded])
    if optional and not required:
        condition = condition & disjunction(optional)
    per_field = [
        F.lit(float(boosts[name]))
        * reduce(lambda a, b: a + b, [F.coalesce(value(a, f), F.lit(0.0)) for a in query.scoring_atoms])
        for f, name in enumerate(fields)
    ]
    best = F.greatest(*per_field) if len(per_field) > 1 else per_field[0]
    return grouped.where(condition).select(*DOCUMENT, F.round(1.0 + best, DECIMALS).alias("score"))


def attach(docs: DataFrame, index: TextIndex, query: TextQuery, boosts: Mapping[str, float] | None = None) -> DataFrame:
    """The documents that match, with their score."""
    boosts = dict(FIELD_BOOSTS if boosts is None else boosts)
    if not query.clauses:
        return docs.where(F.lit(False)).withColumn("score", F.lit(1.0))
    if query.positive:
        return docs.join(score(index, query, boosts), list(DOCUMENT))
    unwanted = score(index, TextQuery(tuple(Clause(c.atoms) for c in query.clauses)), boosts)
    return docs.join(unwanted.select(*DOCUMENT), list(DOCUMENT), "left_anti").withColumn("score", F.lit(1.0))

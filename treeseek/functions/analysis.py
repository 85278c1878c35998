"""Text analysis: text in, array of terms out.

The same chain runs on stored text (as a Column) and on the words of a query
(as a Python string), so that both sides agree on what a term is.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of the tokenisers, as Java patterns.
SEPARATORS = {
    "word": r"[^\p{L}\p{N}]+",
    "letter": r"[^\p{L}]+",
}

# Default articles and stop words of the filters.
FRENCH_ARTICLES = ("l", "m", "t", "qu", "n", "s", "j", "d", "c", "jusqu", "quoiqu", "lorsqu", "puisqu")
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of",
    "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)

# Letters that fold to more than one ASCII letter or do not
# decompose.
WIDE_FOLDS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ı": "i", "ð": "d", "Ð": "D",
}


def _narrow_folds() -> tuple[str, str]:
    """Accented Latin letters and the single ASCII letter each decomposes to."""
    accented, plain = [], []
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii() and base.isalpha():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _narrow_folds()


def fold_column(text: Column) -> Column:
    folded = F.translate(text, _ACCENTED, _PLAIN)
    for letter, ascii_form in WIDE_FOLDS.items():
        folded = F.replace(folded, F.lit(letter), F.lit(ascii_form))
    return folded


def fold_string(text: str) -> str:
    folded = text.translate(str.maketrans(_ACCENTED, _PLAIN))
    for letter, ascii_form in WIDE_FOLDS.items():
        folded = folded.replace(letter, ascii_form)
    return folded


def unfolded(term: str) -> str:
    """A pattern of all texts that fold to a term."""
    forms: dict[str, list[str]] = {}
    for accented, plain in (*zip(_ACCENTED, _PLAIN), *WIDE_FOLDS.items()):
        forms.setdefault(plain.lower(), []).append(accented)
    wide = sorted((plain for plain in forms if len(plain) > 1), key=len, reverse=True)
    out, at = [], 0
    while at < len(term):
        piece = next((p for p in wide if term.startswith(p, at)), None)
        if piece is not None:
            apart = "".join(unfolded_letter(c, forms) for c in piece)
            out.append(f"(?:{apart}|{'|'.join(forms[piece])})")
            at += len(piece)
        else:
            out.append(unfolded_letter(term[at], forms))
            at += 1
    return "".join(out)


def unfolded_letter(letter: str, forms: dict[str, list[str]]) -> str:
    own = letter if letter.isalnum() else f"\\x{{{ord(letter):x}}}"
    same = "".join(forms.get(letter, ()))
    return f"[{own}{same}]" if same else own


@dataclass(frozen=True)
class Analyzer:
    """Tokeniser and filters; the default lower-cases and splits into words."""

    tokenizer: str = "word"
    lowercase: bool = True
    fold: bool = False
    elision: tuple[str, ...] = ()
    stop_words: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.tokenizer not in (*SEPARATORS, "keyword"):
            raise ValueError(f"unknown tokenizer: {self.tokenizer}")

    def _elision_pattern(self) -> str:
        articles = "|".join(re.escape(a) for a in self.elision)
        return rf"(?i)(^|[^\p{{L}}\p{{N}}])(?:{articles})['’]"

    def tokens(self, text: Column) -> Column:
        """Array of terms in text order; null text gives an empty array."""
        value = F.coalesce(text, F.lit(""))
        if self.lowercase:
            value = F.lower(value)
        if self.fold:
            value = fold_column(value)
        if self.elision:
            value = F.regexp_replace(value, self._elision_pattern(), "$1")
        if self.tokenizer == "keyword":
            terms = F.array(value)
        else:
            terms = F.split(value, SEPARATORS[self.tokenizer])
        unwanted = ["", *self.stop_words]
        return F.filter(terms, lambda t: ~t.isin(unwanted) if self.stop_words else t != "")

    def terms(self, text: str) -> list[str]:
        """The same chain for the text of a query."""
        value = text.lower() if self.lowercase else text
        if self.fold:
            value = fold_string(value)
        if self.elision:
            articles = "|".join(re.escape(a) for a in self.elision)
            value = re.sub(rf"(?i)(^|[\W_])(?:{articles})['’]", r"\1", value)
        if self.tokenizer == "keyword":
            found = [value]
        else:
            # The categories that the stored side's patterns name.
            kinds = "LN" if self.tokenizer == "word" else "L"
            found = "".join(c if unicodedata.category(c)[0] in kinds else " " for c in value).split(" ")
        return [t for t in found if t and t not in self.stop_words]


@dataclass(frozen=True)
class AnalyzerSet:
    """One analyser per dimension or field; settings are not merged with the default.

    A field setting wins over a dimension setting, as a mapping wins over the
    settings of its index.
    """

    default: Analyzer = Analyzer()
    by_dimension: dict[str, Analyzer] = field(default_factory=dict)
    by_field: dict[str, Analyzer] = field(default_factory=dict)

    @classmethod
    def from_settings(cls, settings: dict[str, dict]) -> AnalyzerSet:
        """From index settings per dimension, with ``default`` for the others:
        ``{"tokenizer": "letter", "filter": ["asciifolding", "lowercase", "elision", "stop"],
        "articles": [...], "stopwords": [...]}``."""

        def one(spec: dict) -> Analyzer:
            filters = spec.get("filter", ["lowercase"])
            unknown = set(filters) - {"asciifolding", "lowercase", "elision", "stop"}
            if unknown:
                raise ValueError(f"unknown token filters: {sorted(unknown)}")
            return Analyzer(
                tokenizer=spec.get("tokenizer", "word"),
                lowercase="lowercase" in filters,
                fold="asciifolding" in filters,
                elision=tuple(spec.get("articles", FRENCH_ARTICLES)) if "elision" in filters else (),
                stop_words=tuple(spec.get("stopwords", ENGLISH_STOP_WORDS)) if "stop" in filters else (),
            )

        chosen = {name: one(spec["analysis"]) for name, spec in settings.items() if "analysis" in spec}
        default = chosen.pop("default", Analyzer())
        # A dimension with settings of its own does not fall back to the default analysis.
        for name, spec in settings.items():
            if name != "default" and "analysis" not in spec:
                chosen[name] = Analyzer()
        return cls(default, chosen)

    def pick(self, dimension: str | None = None, field_name: str | None = None) -> Analyzer:
        if field_name in self.by_field:
            return self.by_field[field_name]
        return self.by_dimension.get(dimension, self.default)

    def tokens(self, text: Column, dimension: Column, field_name: str) -> Column:
        if field_name in self.by_field:
            return self.by_field[field_name].tokens(text)
        result = None
        for name, analyzer in self.by_dimension.items():
            matches, terms = dimension == name, analyzer.tokens(text)
            result = F.when(matches, terms) if result is None else result.when(matches, terms)
        fallback = self.default.tokens(text)
        return fallback if result is None else result.otherwise(fallback)

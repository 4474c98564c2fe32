"""Secret scanning: all rules as one automaton, one pass over the bytes.

The rules' search forms are compiled together (``automaton``); one pass over every text marks where
some rule ends. Spans come from the marked pieces alone: the rule's loose form, read backward, marks in
one pass all places where a match begins; from the leftmost one the longest match is taken, then from the
next one behind it, without overlap inside a kind, and a match counts if the strict form ends at the same
place. Matches that fail still use up their text, as in a search with a pattern followed by a filter.

Results for odd rows: null and empty texts have no spans; positions are code points of the whole
text; very long texts are cut only at places that no match can cross; repeated rows give repeated
results; an empty table gives an empty one; a given column named like the result is replaced.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from patio.llm.automaton import breaks, compile_rules, ends_of, longest_from, starts_in
from patio.llm.batches import add_columns, code_points


@dataclass(frozen=True)
class SecretRule:
    """``strict`` holds where the kind counts; ``loose`` is what a search consumes, ``search`` a short
    form that lies somewhere inside every strict match."""

    kind: str
    strict: str
    loose: str = ""
    search: str = ""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


#: Fixed forms of the contract's kinds, in their order.
_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=\-]"
BASE_RULES = [
    SecretRule("assign", _ASSIGN + "{12,}", _ASSIGN + "+", _ASSIGN),
    SecretRule("access", "AKIA[A-Z0-9]{14,}", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]"),
    SecretRule("hex", "[0-9a-f]{16,}", "[0-9a-f]+", "[0-9a-f]{16}"),
]
#: Further kinds of the method.
METHOD_RULES = [
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", search=r"-----BEGIN "),
    SecretRule("github", "gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]"),
    SecretRule("slack", r"xox[abprs]\-[A-Za-z0-9\-]{10,}", r"xox[abprs]\-[A-Za-z0-9\-]+", r"xox[abprs]\-"),
    SecretRule("google", r"AIza[A-Za-z0-9_\-]{35,}", r"AIza[A-Za-z0-9_\-]+", "AIza"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}",
               r"eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", r"eyJ[A-Za-z0-9_\-]+\."),
    SecretRule("url_login", r"[a-z]+://[A-Za-z0-9._%+\-]+:[A-Za-z0-9!$&*._~%+\-]+@",
               search=r"://[A-Za-z0-9._%+\-]+:[A-Za-z0-9!$&*._~%+\-]+@"),
]
RULES = BASE_RULES + METHOD_RULES


class Scanner:
    """The compiled rules; small arrays that go to the tasks with the function that uses them."""

    def __init__(self, rules=RULES):
        self.kinds = [r.kind for r in rules]
        self.search = compile_rules([r.search or r.loose or r.strict for r in rules], anywhere=True)
        # a place that no match of any rule crosses; each rule by itself stays small
        self.resets = np.logical_and.reduce([
            compile_rules([r.loose or r.strict], anywhere=True).resets() for r in rules])
        # spans are delimited rule by rule, so that a place where another rule goes on is left at once
        self.loose = [compile_rules([r.loose or r.strict], anywhere=False) for r in rules]
        self.back = [compile_rules([r.loose or r.strict], anywhere=True, backward=True) for r in rules]
        self.strict = [compile_rules([r.strict], anywhere=False) for r in rules]

    def spans(self, body: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, start byte, kind, end byte) of all spans, in order, in bytes of ``body``."""
        places = breaks(self.resets, body, offsets)
        where, marks = ends_of(self.search, self.search.classes[body], places)
        piece = np.searchsorted(places, where, "right") - 1
        out = []
        for rule in range(len(self.kinds)):
            bit, loose_form, strict_form = 1 << rule, self.loose[rule], self.strict[rule]
            for p in np.unique(piece[(marks & bit) != 0]):
                first, last = int(places[p]), int(places[p + 1])
                part = body[first:last]
                loose = loose_form.classes[part].tolist()
                strict = strict_form.classes[part].tolist()
                end = 0
                for at in starts_in(self.back[rule], self.back[rule].classes[part].tolist()):
                    if at < end:
                        continue
                    end = longest_from(loose_form, loose, at)
                    if longest_from(strict_form, strict, at, end) == end:
                        out.append((first + at, rule, first + end))
        if not out:
            return []
        texts = np.searchsorted(offsets, [s for s, _, _ in out], "right") - 1
        return sorted((int(t), s, r, e) for t, (s, r, e) in zip(texts, out))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find_secrets(df: DataFrame, text: str = "text", into: str = "secrets", keep=None,
                 rules=RULES) -> DataFrame:
    """The kept columns and an array of spans (kind, start, end), by start, then kind as listed."""
    scanner = Scanner(rules)

    def work(body, offsets):
        lists = [[] for _ in range(len(offsets) - 1)]
        found = scanner.spans(body, offsets)
        at = 0
        while at < len(found):
            text_no = found[at][0]
            stop = at
            while stop < len(found) and found[stop][0] == text_no:
                stop += 1
            lo, hi = offsets[text_no], offsets[text_no + 1]
            edges = np.array([(s, e) for _, s, _, e in found[at:stop]]) - lo
            points = code_points(body[lo:hi], edges.reshape(-1)).reshape(-1, 2)
            lists[text_no] = [
                {"kind": scanner.kinds[found[at + i][2]], "start": int(a), "end": int(b)}
                for i, (a, b) in enumerate(points)]
            at = stop
        return [pa.array(lists, pa.list_(_ARROW_SPAN))]

    added = T.StructType([T.StructField(into, T.ArrayType(SPAN))])
    return add_columns(df, text, added, work, keep)

"""Many text rules in one pass.

One Aho-Corasick automaton holds the strings of which every match of a rule's pattern must hold one (``functions.text.needed`` reads them off the pattern). It runs over a text once, and
only the patterns whose strings occurred are tried; a text's cost hardly depends on the number of rules. For a handful of rules
``functions.text.exclusion_tags`` stays in the JVM and is faster.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import text as T


class RuleBook:
    """Rules (tag, pattern), case aside, ``.`` matching line ends too; a tag may have several."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = [(tag, re.compile(pattern, re.IGNORECASE | re.DOTALL)) for tag, pattern in rules]
        self.always: list[int] = []
        held: dict[str, list[int]] = {}
        for k, (_, pattern) in enumerate(rules):
            strings = T.needed(pattern, True)
            for s in strings:
                held.setdefault(s, []).append(k)
            if not strings:
                self.always.append(k)
        self.strings = ahocorasick.Automaton()
        for s, of in held.items():
            self.strings.add_word(s, tuple(of))
        if held:
            self.strings.make_automaton()

    def candidates(self, text: str) -> list[int]:
        """Rules that may match: those without a string they need, and those of which one occurs."""
        seen: set[tuple[int, ...]] = set()
        if len(self.strings):
            seen = {of for _, of in self.strings.iter(text.lower())}
        return sorted({*self.always, *(k for of in seen for k in of)})

    def tags(self, text: str) -> list[str]:
        found: set[str] = set()
        for k in self.candidates(text):
            tag, pattern = self.rules[k]
            if tag not in found and pattern.search(text):
                found.add(tag)
        return sorted(found)


def tagged(docs: DataFrame, rules: list[tuple[str, str]], *, text: str = "text", name: str = "tags") -> DataFrame:
    """``docs`` with ``name``: the sorted tags of which a rule matches the text; none for a null or empty text. Texts are read whole. A column of that name is replaced."""
    docs = docs.drop(name)
    place = docs.columns.index(text)
    made: list[RuleBook] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(RuleBook(rules))
        for batch in batches:
            tags = [made[0].tags(t) if t else [] for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tags, pa.list_(pa.string()))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, ArrayType(StringType()))]))

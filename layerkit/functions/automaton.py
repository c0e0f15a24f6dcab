"""Many strings looked for at once: one walk over each text, in Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_KEPT: list = [None, None]


def _automaton(shared):
    """This worker's automaton of a broadcast list, compiled once."""
    if _KEPT[0] is not shared:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for i, (wanted, _) in enumerate(shared.value):
            automaton.add_word(wanted, i)
        if len(automaton):
            automaton.make_automaton()
        _KEPT[:] = shared, automaton
    return _KEPT[1]


def strings_held(text: Column, shared) -> Column:
    """Of the broadcast (string, label) pairs the labels whose string occurs in
    ``text``, each once, in the order of the list; a null text holds none."""
    @F.arrow_udf("array<string>")
    def held(texts: pa.Array) -> pa.Array:
        automaton = _automaton(shared)
        labels = [label for _, label in shared.value]
        out = []
        for t in texts.to_pylist():
            found = {i for _, i in automaton.iter(t)} if t and len(automaton) else ()
            out.append([labels[i] for i in sorted(found)])
        return pa.array(out, pa.list_(pa.string()))

    return held(text)

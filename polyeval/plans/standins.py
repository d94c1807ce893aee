"""Deterministic stand-ins for the learned plug-ins (scorers, generator),
used by the registered queries and tests so the plug-in path is exercised
and its output can be checked in SQL. Factories are top-level functions so
they pickle to the workers."""

from __future__ import annotations


def _ratio(a: str, b: str) -> float:
    return min(len(a), len(b)) / max(len(a), len(b), 1)


def _length_ratio(batch):
    return [_ratio(t["mt"], t["ref"]) for t in batch]


def _source_ratio(batch):
    return [_ratio(t["mt"], t["src"]) for t in batch]


def _length_error(batch):
    return [25.0 * (1.0 - _ratio(t["mt"], t["ref"])) for t in batch]


def length_ratio_scorer():
    """Segment score = shorter/longer length of hypothesis and reference."""
    return _length_ratio


def source_ratio_scorer():
    return _source_ratio


def length_error_scorer():
    """Segment *error* in [0, 25] (lower is better), like the back-filled metric."""
    return _length_error


class _EchoGenerator:
    def __init__(self, model: str):
        self.model = model

    def __call__(self, prompts, params):
        return [f"  {len(p)} {params['temperature']}\n" for p in prompts]


def echo_generator(model: str):
    """'Generates' the prompt length and the temperature, padded with
    whitespace (so the strip step is exercised)."""
    return _EchoGenerator(model)


#: A scorer as a program of its own (see ``operators.external``): the error of a segment is 25 times
#: the share by which the shorter of hypothesis and reference falls short of the longer.
SCORER_PROGRAM = """
import json, sys
for line in sys.stdin:
    for _ in range(json.loads(line)["n"]):
        row = json.loads(sys.stdin.readline())
        a, b = len(row["hypothesis"]), len(row["reference"])
        print(json.dumps({"prediction": 25.0 * (1.0 - min(a, b) / max(a, b, 1))}))
    sys.stdout.flush()
"""

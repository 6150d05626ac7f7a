"""URL filters: host and path rules, and a model of character n-grams (9).

The longest fitting rule decides. Where none fits, logistic regression on hashed character n-grams of
host and path decides, trained from a small labelled table of URLs (`url_labels`, or one's own).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from headway.llm.common import pick, slices, table, texts_of
from headway.llm.url_labels import ALLOWED, BLOCKED

DIMENSIONS = 1 << 14
GRAMS = (2, 3, 4)
#: First labels that sites of every kind have; like the last label, they say nothing.
COMMON_LABELS = ("www", "m", "blog")
THRESHOLD = 0.6

#: (verdict, host, path): a rule fits its host, all subdomains, and paths that begin with its path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_SMALL = {c: c + 32 for c in range(65, 91)}


def parts_of(url: str | None) -> tuple[str, str]:
    """Host, in small letters, and path; both empty without `://`."""
    found = _URL.search(url) if url else None
    return (found[1].translate(_SMALL), found[2]) if found else ("", "")


def rule_for(host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> tuple[str, str] | None:
    """(verdict, rule) of the longest rule that fits."""
    fits = [
        (verdict, its_host + its_path)
        for verdict, its_host, its_path in rules
        if (host == its_host or host.endswith("." + its_host)) and path.startswith(its_path)
    ]
    return max(fits, key=lambda rule: len(rule[1])) if fits else None


def grams(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of host and path, each in its own half of the dimensions."""
    labels = host.split(".")
    labels = labels[:-1] or labels
    if len(labels) > 1 and labels[0] in COMMON_LABELS:
        labels = labels[1:]
    half, found = DIMENSIONS // 2, set()
    for part, offset in (("^" + ".".join(labels) + "$", 0), ("^" + path + "$", half)):
        for n in GRAMS:
            for i in range(len(part) - n + 1):
                found.add(offset + crc32(part[i : i + n].encode()) % half)
    return np.fromiter(sorted(found), dtype=np.int64, count=len(found))


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    intercept: float

    def probability(self, host: str, path: str) -> float:
        """Probability that the URL is unwanted."""
        found = grams(host, path)
        score = self.intercept
        if len(found):
            score += self.weights[found].sum() / np.sqrt(len(found))
        return float(1 / (1 + np.exp(-np.clip(score, -30, 30))))


@lru_cache(maxsize=4)
def train(
    allowed: tuple[str, ...] = ALLOWED, blocked: tuple[str, ...] = BLOCKED, rounds: int = 600
) -> UrlModel:
    """Ridged logistic regression by gradient descent on the labelled URLs."""
    rows = [parts_of("://" + url) for url in allowed + blocked]
    labels = np.array([0.0] * len(allowed) + [1.0] * len(blocked))
    x = np.zeros((len(rows), DIMENSIONS))
    for i, (host, path) in enumerate(rows):
        found = grams(host, path)
        x[i, found] = 1 / np.sqrt(max(1, len(found)))
    w, b = np.zeros(DIMENSIONS), 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(x @ w + b))) - labels
        w -= 10.0 * (x.T @ error / len(rows) + 1e-3 * w)
        b -= 0.5 * error.mean()
    return UrlModel(w, float(b))


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    model: UrlModel | None = None,
) -> DataFrame:
    """`id_col`, host, path, rule, verdict and, where the model decided, its probability.

    Null and malformed URLs have empty host and path, fit no rule and are left to the model. Rows
    with equal or null ids stay separate, other columns are ignored, an empty table gives no rows.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    learnt = model or train()

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "c1"):
            rows = []
            for url in texts_of(batch.column("c1")):
                host, path = parts_of(url)
                if rule := rule_for(host, path, rules):
                    rows.append((host, path, rule[1], rule[0], None))
                else:
                    p = learnt.probability(host, path)
                    rows.append((host, path, None, "block" if p >= THRESHOLD else "allow", p))
            columns = list(zip(*rows)) or [()] * 5
            arrays = [batch.column("c0"), *(pa.array(c, pa.string()) for c in columns[:4])]
            arrays.append(pa.array(columns[4], pa.float64()))
            names = [id_col, "host", "path", "rule", "verdict", "probability"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"`{id_col}` {kind}, host STRING, path STRING, rule STRING, verdict STRING, probability DOUBLE"
    return pick(pages, id_col, url_col).mapInArrow(judge, schema)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))

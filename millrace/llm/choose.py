"""Choice of the classifiers' settings by cross-validation on rows that may be learnt from.

Run as ``python -m millrace.llm.choose FOLDER``; held-out rows are never read.  The
settings in ``quality`` and ``toxicity`` are the best ones of these grids, and of
equally good ones the first.
"""

from __future__ import annotations

import itertools
import sys
import zlib

import numpy as np

from millrace.llm import quality, toxicity
from millrace.llm.bytewords import as_bytes

FOLDS = 4
QUALITY = {"DIMENSIONS": (48, 24, 96), "NEIGHBOURS": (10, 25, 50), "SHARPNESS": (16.0, 8.0, 1.0)}
TOXICITY = {"FEATURES": (2000, 500), "LEAST_LIFT": (1.0, 1.5), "RIDGE": (0.2, 0.05, 1.0)}


def errors_of_quality(counts: np.ndarray, truth: np.ndarray, fold: np.ndarray, at: float = 0.3) -> dict[tuple, int]:
    """Wrong predictions over all folds, for each setting of ``QUALITY``."""
    wrong = {}
    for d, k, sharp in itertools.product(*QUALITY.values()):
        quality.SHARPNESS, count = sharp, 0
        for f in range(FOLDS):
            model = quality._fit(counts[fold != f], truth[fold != f].tolist(), d)
            count += int(((model.vote(counts[fold == f], k) >= at) != truth[fold == f]).sum())
        wrong[d, k, sharp] = count
    return wrong


def errors_of_toxicity(texts: list[str], truth: np.ndarray, fold: np.ndarray, at: float = 0.3) -> dict[tuple, int]:
    """Wrong predictions over all folds, for each setting of ``TOXICITY``."""
    wrong, sets = {}, [toxicity.features(as_bytes(t)) for t in texts]
    for most, lift, ridge in itertools.product(*TOXICITY.values()):
        toxicity.LEAST_LIFT, count = lift, 0
        for f in range(FOLDS):
            mine = np.flatnonzero(fold != f)
            model = toxicity.fit([texts[i] for i in mine], truth[mine].tolist(), most=most, ridge=ridge)
            logits = np.array([model.logit(sets[i]) for i in np.flatnonzero(fold == f)])
            count += int(((1 / (1 + np.exp(-logits)) >= at) != truth[fold == f]).sum())
        wrong[most, lift, ridge] = count
    return wrong


def main(folder: str) -> None:
    import pyarrow.parquet as pq

    documents = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    texts = dict(zip(documents.column("doc_id").to_pylist(), documents.column("text").to_pylist(), strict=True))
    labels = pq.read_table(f"{folder}/labels.parquet").to_pylist()
    hashed = lambda i: zlib.crc32(str(i).encode())
    for name, column, allowed in (("quality", "quality", lambda i: hashed(i) % 5 != 0), ("toxicity", "toxic", lambda i: hashed(i) % 4 != 2)):
        rows = [r for r in labels if r["doc_id"] in texts and r[column] in (0, 1) and allowed(r["doc_id"])]
        rows = sorted(rows, key=lambda r: hashed(f"{r['doc_id']} chosen"))[: quality.SAMPLE]
        truth = np.array([r[column] for r in rows])
        fold = np.arange(len(rows)) % FOLDS
        found = [texts[r["doc_id"]] or "" for r in rows]
        if name == "quality":
            wrong = errors_of_quality(np.array([quality.terms(as_bytes(t)) for t in found], np.float32), truth, fold)
        else:
            wrong = errors_of_toxicity(found, truth, fold)
        best = min(wrong, key=wrong.get)
        print(f"{name}: {len(rows)} allowed rows, best {best} with {wrong[best]} wrong, worst {max(wrong.values())}; all: {wrong}")


if __name__ == "__main__":
    main(sys.argv[1])

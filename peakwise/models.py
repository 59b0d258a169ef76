"""Loaders for :func:`peakwise.operators.embedding.embed_spectra`."""

from __future__ import annotations

import numpy as np


def _opened(path: str):
    """A file of any file system, open for reading."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    files, inner = fs.FileSystem.from_uri(path)
    return files.open_input_file(inner)


class SparseDense:
    """Fully connected network whose first layer adds up weight rows of occupied bins.

    ``path`` is an ``.npz`` with ``w0, b0, w1, b1, ...`` (weights as inputs x outputs), on a
    file system of every executor or under a URI that pyarrow can open, such as ``s3://`` or
    ``hdfs://``; every layer but the last is followed by ReLU.  Use with ``dense=False``.
    """

    def __init__(self, path: str):
        self.path = path

    def __call__(self):
        with _opened(self.path) as file, np.load(file) as arrays:
            depth = len(arrays.files) // 2
            layers = [(arrays[f"w{i}"], arrays[f"b{i}"]) for i in range(depth)]

        def predict(bin_lists: list[np.ndarray]) -> np.ndarray:
            first_w, first_b = layers[0]
            x = np.stack([first_w[np.asarray(b, dtype=np.int64)].sum(axis=0) for b in bin_lists])
            x = x + first_b
            for w, b in layers[1:]:
                x = np.maximum(x, 0.0) @ w + b
            return x

        return predict

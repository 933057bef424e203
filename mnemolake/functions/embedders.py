"""Named embedders: ``list[str] -> list[list[float]]``, run on executors in Arrow batches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

from ..schemas import DIMS

EmbedFn = Callable[[list[str]], list[list[float]]]
Factory = Callable[[int, str], EmbedFn]

_REGISTRY: dict[str, Factory] = {}


class EmbeddingError(RuntimeError):
    """An embedding failed and the embedder is not fail-open."""


def register_embedder(provider: str, factory: Factory) -> None:
    """Register a provider.

    ``factory(dim, model)`` runs once per partition on the executor and returns the batch function,
    so clients and models are opened there and never shipped.
    """
    _REGISTRY[provider] = factory


def embedder_factory(provider: str) -> Factory:
    if provider not in _REGISTRY:
        raise ValueError(f"unknown embedding provider {provider!r}; registered: {sorted(_REGISTRY)}")
    return _REGISTRY[provider]


def registered_embedders() -> list[str]:
    return sorted(_REGISTRY)


@dataclass(frozen=True)
class EmbedSpec:
    """Which embedder makes the vectors of one width, and how failures are treated.

    A text that fails gets a zero vector (``fail_open``), no vector and the status ``error`` (``keep_errors``, which
    goes first), or ends the job.
    """

    dim: int
    provider: str
    model: str = ""
    fail_open: bool = True
    parallelism: int | None = None
    keep_errors: bool = False
    dims: tuple[int, ...] = field(default=DIMS, repr=False)

    def __post_init__(self) -> None:
        if self.dim not in self.dims:
            raise ValueError(f"unsupported dim {self.dim}; expected one of {list(self.dims)}")


def _noop(dim: int, model: str) -> EmbedFn:
    return lambda texts: [[0.0] * dim for _ in texts]


def _hashing(dim: int, model: str) -> EmbedFn:
    """Feature hashing (Weinberger et al. 2009): token counts per hashed slot, scaled to length 1."""
    word = re.compile(r"[^\W_]+")
    slots: dict[str, int] = {}

    def slot(token: str) -> int:
        if token not in slots:
            if len(slots) > 500_000:
                slots.clear()
            slots[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dim
        return slots[token]

    def embed(texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            counts = np.bincount([slot(t) for t in word.findall(text.lower())], minlength=dim).astype("f8")
            length = np.sqrt(counts @ counts)
            out.append((counts / length if length else counts).astype("f4"))
        return out

    return embed


register_embedder("noop", _noop)
register_embedder("hashing", _hashing)

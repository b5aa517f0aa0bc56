"""A registry of detectors: factories of Arrow functions by kind and name.

A detector that needs weights that are not there is UNAVAILABLE: its checks become UNKNOWN, never PASS.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

KINDS = ("vad", "noise", "quality", "speaker")
_FACTORIES: dict[tuple[str, str], Callable] = {}


@dataclass(frozen=True)
class Info:
    name: str
    kind: str
    available: bool
    reason: str = ""
    revision: str = ""


class Unavailable:
    """Stands for a detector whose weights are missing."""

    def __init__(self, name: str, kind: str, reason: str) -> None:
        self.info = Info(name, kind, False, reason)

    def infer(self, *_a, **_k):  # noqa: ANN002, ANN003, ANN201
        return None


def register(kind: str, name: str) -> Callable:
    """Decorator for a class whose instances have info and infer(samples, rate, ...)."""
    if kind not in KINDS:
        raise ValueError(f"no such kind: {kind}")

    def add(factory: Callable) -> Callable:
        _FACTORIES[kind, name] = factory
        return factory

    return add


def create(kind: str, name: str, **options):  # noqa: ANN003, ANN201
    """A detector; options that its constructor does not take are left out."""
    import inspect

    if (kind, name) not in _FACTORIES:
        raise KeyError(f"{kind}/{name}; there are {names(kind)}")
    f = _FACTORIES[kind, name]
    known = inspect.signature(f).parameters
    return f(**{k: v for k, v in options.items() if k in known})


def names(kind: str) -> list[str]:
    return sorted(n for k, n in _FACTORIES if k == kind)


def availability(detectors: dict[str, object]) -> dict[str, bool]:
    """What the policy may rely on."""
    return {k: bool(getattr(getattr(d, "info", None), "available", False)) for k, d in detectors.items()}


@register("vad", "energy")
class EnergyVad:
    def __init__(self, margin_db: float = 12.0, gap: float = 0.3, least: float = 0.15) -> None:
        self.margin_db, self.gap, self.least = margin_db, gap, least
        self.info = Info("energy", "vad", True, revision="1")

    def infer(self, mono, rate: int) -> list[list[float]]:  # noqa: ANN001
        from corpusloom.operators.signal import speech

        return speech(mono, rate, self.margin_db, gap=self.gap, least=self.least)


@register("noise", "dsp")
class DspNoise:
    def __init__(self, hiss: float = 0.4, hum: float = 0.15, clip: float = 0.005) -> None:
        self.hiss, self.hum, self.clip = hiss, hum, clip
        self.info = Info("dsp", "noise", True, revision="1")

    def infer(self, mono, rate: int, voiced: list[list[float]]) -> list[dict]:  # noqa: ANN001
        from corpusloom.operators.signal import noise_events

        return noise_events(mono, rate, voiced, self.hiss, self.hum, self.clip)


def _weights(kind: str, name: str) -> None:
    """A detector of ONNX weights: unavailable unless the file is there and has the pinned hash."""

    def make(model_path: str = "", sha256: str = "", run: Callable | None = None):  # noqa: ANN202
        import hashlib
        import os

        if not model_path or not os.path.isfile(model_path):
            return Unavailable(name, kind, "no weights")
        with open(model_path, "rb") as f:
            if not sha256 or hashlib.sha256(f.read()).hexdigest() != sha256:
                return Unavailable(name, kind, "weights differ from the pinned hash")
        if run is None:
            return Unavailable(name, kind, "no runner")
        return type("Onnx", (), {"info": Info(name, kind, True, revision=sha256[:12]), "infer": staticmethod(run)})()

    register(kind, name)(make)


for _kind, _name in (("vad", "onnx"), ("noise", "music"), ("quality", "perceptual"), ("speaker", "overlap")):
    _weights(_kind, _name)

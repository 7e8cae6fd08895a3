"""Models behind taggers: loaded once for each Python worker and device, on stages that ask for accelerators.

A stage resource profile gives each task its accelerators; a worker keeps what it has loaded from task to task, keyed by
backend, model, device and precision, so a model is loaded as often as there are workers, not once a task or a text.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark import TaskContext
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests

#: Texts after which an allocator's cache is emptied, and the kinds of devices in the order of preference.
FLUSH_EVERY = 50
PREFERRED = ("cuda", "mps", "cpu")

Found = tuple[int, int, str, float]


class Backend(Protocol):
    """A framework that runs models. It is sent to the workers, so it loads nothing by itself."""

    def devices(self) -> Sequence[str]:
        """Devices that this machine has, such as cuda:0, mps, cpu."""

    def load(self, model: str, device: str, half: bool) -> Any:
        """The model on a device, in half precision if `half`."""

    def predict(self, model: Any, texts: list[str], labels: list[str], threshold: float) -> list[Iterable[Found]]:
        """(start, end, label, score) of the mentions in each text."""

    def flush(self, device: str) -> None:
        """Give unused memory of the device back."""


def kind(device: str) -> str:
    return device.partition(":")[0]


def task_devices() -> list[str]:
    """The accelerators that Spark has given the running task."""
    here = TaskContext.get()
    gpus = here.resources().get("gpu") if here is not None else None
    return [f"cuda:{a}" for a in gpus.addresses] if gpus else []


def pick_device(requested: str, have: Sequence[str], given: Sequence[str] = ()) -> str:
    """The device to use: as requested, which must be there, or for `auto` the first `given` to the task, else the best kind the machine has."""
    requested = (requested or "auto").strip()
    kinds = {kind(d) for d in [*have, *given]} | {"cpu"}
    if requested.lower() != "auto":
        if kind(requested) not in kinds:
            raise RuntimeError(f"device {requested} is not available")
        return requested
    if given:
        return given[0]
    best = [d for k in PREFERRED for d in have if kind(d) == k]
    return best[0] if best else "cpu"


def half_precision(setting: str, device: str) -> bool:
    """Whether to halve a model: on and auto do so on cuda only, where it is stable; off never."""
    setting = (setting or "auto").lower()
    if setting not in ("auto", "on", "off"):
        raise ValueError("half precision is auto, on or off")
    return setting != "off" and kind(device) == "cuda"


class Registry:
    """What a worker has loaded. Threads that want the same model wait for one to load it; a failed load is tried again."""

    def __init__(self):
        self._lock = threading.Lock()
        self._slots: dict[tuple, tuple[threading.Lock, list]] = {}

    def get(self, backend: Backend, model: str, device: str, half: bool) -> Any:
        key = (type(backend).__module__, type(backend).__qualname__, getattr(backend, "key", None), model, device, half)
        with self._lock:
            lock, held = self._slots.setdefault(key, (threading.Lock(), []))
        with lock:
            if not held:
                held.append(backend.load(model, device, half))
            return held[0]

    def clear(self) -> None:
        with self._lock:
            self._slots.clear()


#: One for each Python worker: a module is imported once, and workers are used again by later tasks.
LOADED = Registry()


@dataclass
class ModelTagger:
    """A tagger that runs a model of a backend. It goes to the workers as settings; the model is loaded there on first use."""

    backend: Backend
    model: str
    device: str = "auto"
    half: str = "auto"
    flush_every: int = FLUSH_EVERY
    batch: int = 32
    _seen: int = field(default=0, repr=False)
    _device: str | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_seen": 0, "_device": None}

    def chosen(self) -> tuple[str, bool]:
        """Device and precision on this worker."""
        if self._device is None:
            self._device = pick_device(self.device, self.backend.devices(), task_devices())
        return self._device, half_precision(self.half, self._device)

    def predict_many(self, texts: list[str], labels: list[str], threshold: float) -> list[Iterable[Found]]:
        device, half = self.chosen()
        loaded = LOADED.get(self.backend, self.model, device, half)
        return [x for at in range(0, len(texts), self.batch) for x in self.backend.predict(loaded, texts[at : at + self.batch], labels, threshold)]

    def predict(self, text: str, labels: list[str], threshold: float) -> Iterable[Found]:
        return self.predict_many([text], labels, threshold)[0]

    def after_text(self) -> None:
        """Told after each text: every so many of them, an mps allocator's cache is emptied. A flush that fails costs nothing."""
        self._seen += 1
        if self.flush_every > 0 and self._seen % self.flush_every == 0 and kind(self.chosen()[0]) == "mps":
            try:
                self.backend.flush(self.chosen()[0])
            except Exception:  # the memory stays where it is
                return


class GlinerBackend:
    """Span models of the gliner package on torch; both are imported on the workers only."""

    def devices(self) -> list[str]:
        import torch

        found = [f"cuda:{i}" for i in range(torch.cuda.device_count())] if torch.cuda.is_available() else []
        return found + (["mps"] if torch.backends.mps.is_available() else []) + ["cpu"]

    def load(self, model: str, device: str, half: bool) -> Any:
        from gliner import GLiNER

        loaded = GLiNER.from_pretrained(model).to(device)
        return loaded.half() if half else loaded

    def predict(self, model: Any, texts: list[str], labels: list[str], threshold: float) -> list[Iterable[Found]]:
        return [[(m["start"], m["end"], m["label"], m["score"]) for m in found] for found in model.batch_predict_entities(texts, labels, threshold=threshold)]

    def flush(self, device: str) -> None:
        import torch

        torch.mps.empty_cache()


def stage_profile(accelerators: float = 1, executor_accelerators: int = 1, task_cores: int = 1, executor_cores: int | None = None, executor_memory: str | None = None, discovery_script: str = "") -> ResourceProfile:
    """Resources of a stage that runs models, for `profile` of tagger.tag(): a share of a GPU (or several) for each task.

    Only that stage takes them; cluster managers with dynamic allocation, or standalone ones, can serve it.
    """
    executor = ExecutorResourceRequests().resource("gpu", executor_accelerators, discovery_script)
    if executor_cores:
        executor.cores(executor_cores)
    if executor_memory:
        executor.memory(executor_memory)
    return ResourceProfileBuilder().require(executor).require(TaskResourceRequests().cpus(task_cores).resource("gpu", accelerators)).build

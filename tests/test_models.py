import os
import pathlib
import threading
import time

import pytest

from spanlake.operators import models as M
from spanlake.operators import tagger as T


class Logged(M.GlinerBackend):
    """A stand-in that finds capitalised words and leaves a file for each load, prediction and flush."""

    def __init__(self, folder, have=("cpu",)):
        self.folder, self.have = str(folder), have
        self.key = self.folder

    def _log(self, what):
        pathlib.Path(self.folder, f"{what}-{os.getpid()}-{time.time_ns()}").touch()

    def devices(self):
        return list(self.have)

    def load(self, model, device, half):
        time.sleep(0.05)
        self._log(f"load={model}={device}={half}")
        return T.PatternTagger({"NAME": (r"[A-Z][a-z]+", 0.9)})

    def predict(self, model, texts, labels, threshold):
        self._log(f"predict={len(texts)}")
        return [list(model.predict(t, labels, threshold)) for t in texts]

    def flush(self, device):
        self._log(f"flush={device}")


def logs(folder, what):
    return [p.name for p in pathlib.Path(folder).iterdir() if p.name.startswith(what)]


def mentions(df):
    return sorted((r.doc_id, r.seq, r.window, r.start, r.end, r.entity) for r in df.collect())


def test_one_load_for_each_worker_over_many_tasks_and_jobs(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"Alpha beta Gamma {'x ' * (i % 300)} Delta") for i in range(200)], "doc_id long, text string").repartition(12)
    tagger = M.ModelTagger(Logged(tmp_path), "m")
    plain = T.tag(docs, T.PatternTagger({"NAME": (r"[A-Z][a-z]+", 0.9)}), ["NAME"])
    for _ in range(3):
        assert mentions(T.tag(docs, tagger, ["NAME"])) == mentions(plain)
    loads = [x.split("-") for x in logs(tmp_path, "load")]
    workers = {pid for _, pid, _ in (x.split("-") for x in logs(tmp_path, "predict"))}
    assert {x[0] for x in loads} == {"load=m=cpu=False"}
    assert sorted(x[1] for x in loads) == sorted(workers)  # 36 tasks, one load for each worker that has run any
    assert len(logs(tmp_path, "predict")) >= 36


def test_other_settings_load_anew(tmp_path):
    b = Logged(tmp_path, ("cuda:0", "mps", "cpu"))
    for device, half in (("auto", "auto"), ("auto", "on"), ("auto", "off"), ("cpu", "on"), ("mps", "auto")):
        M.ModelTagger(b, "m", device, half).predict("A text", ["NAME"], 0.5)
    assert sorted(x.split("-")[0] for x in logs(tmp_path, "load")) == ["load=m=cpu=False", "load=m=cuda:0=False", "load=m=cuda:0=True", "load=m=mps=False"]


def test_threads_share_one_load(tmp_path):
    reg, b = M.Registry(), Logged(tmp_path)
    got = []
    threads = [threading.Thread(target=lambda: got.append(reg.get(b, "m", "cpu", False))) for _ in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len({id(x) for x in got}) == 1 and len(logs(tmp_path, "load")) == 1


def test_a_failed_load_is_tried_again():
    class Flaky(Logged):
        fails = 1

        def load(self, *a):
            if self.fails:
                self.fails -= 1
                raise OSError("not yet")
            return "model"

    reg, b = M.Registry(), Flaky("/nowhere")
    with pytest.raises(OSError):
        reg.get(b, "m", "cpu", False)
    assert reg.get(b, "m", "cpu", False) == "model"


def test_devices():
    assert M.pick_device("auto", ["cpu", "mps", "cuda:0", "cuda:1"]) == "cuda:0"
    assert M.pick_device("auto", ["cpu", "mps"]) == "mps" and M.pick_device("", []) == "cpu" and M.pick_device("cpu", []) == "cpu"
    assert M.pick_device("auto", ["cuda:0", "cuda:1"], given=["cuda:1"]) == "cuda:1"  # what Spark gave the task
    assert M.pick_device(" cuda:1 ", ["cuda:0"]) == "cuda:1"
    for wanted in ("cuda", "mps", "cuda:0"):
        with pytest.raises(RuntimeError, match="not available"):
            M.pick_device(wanted, ["cpu"])


def test_half_precision():
    assert [M.half_precision(s, d) for s in ("auto", "on", "off", "") for d in ("cuda:0", "mps", "cpu")] == [True, False, False, True, False, False, False, False, False, True, False, False]
    with pytest.raises(ValueError):
        M.half_precision("maybe", "cpu")


def test_flush_every_so_many_texts_on_mps_only(tmp_path):
    for have, every, want in ((("mps",), 3, 3), (("mps",), 0, 0), (("cuda:0",), 3, 0)):
        folder = tmp_path / f"{have[0]}-{every}"
        folder.mkdir()
        t = M.ModelTagger(Logged(folder, have), "m", flush_every=every)
        list(T._predicted(t, ["Ab " * 500] * 10, ["NAME"], 0.5, 220, 50))  # texts count, not windows
        assert len(logs(folder, "flush")) == want


def test_windows_go_in_batches(tmp_path):
    t = M.ModelTagger(Logged(tmp_path), "m", batch=10)
    got = list(T._predicted(t, ["Ab " * 1000, "", "Cd"], ["NAME"], 0.5, 40, 10))
    assert [(i, w) for i, _, w, _, _ in got] == [(0, w) for w in range(33)] + [(1, 0), (2, 0)]
    assert sorted(x.split("-")[0] for x in logs(tmp_path, "predict")) == ["predict=10"] * 3 + ["predict=5"]


def test_stage_profile(spark):
    p = M.stage_profile(0.5, 2, task_cores=2, executor_cores=4, executor_memory="8g", discovery_script="/x/gpus.sh")
    assert p.taskResources["gpu"].amount == 0.5 and p.taskResources["cpus"].amount == 2.0
    assert p.executorResources["gpu"].amount == 2 and p.executorResources["gpu"].discoveryScript == "/x/gpus.sh" and p.executorResources["cores"].amount == 4

import io
import json
import sys
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from spanlake import cli
from spanlake.sources import artifacts, config


def test_commands_end_to_end(spark, tmp_path, capsys):
    p = lambda *x: str(tmp_path.joinpath(*x))
    spark.createDataFrame([(1, "Cortex and Thalamus. Cortex again."), (2, None)], "doc_id long, text string").write.parquet(p("docs"))
    spark.createDataFrame([("GO:1", "Cortex", "go"), ("not an iri", "Thalamus", "go")], "ontology_id string, ontology_label string, ontology string").write.parquet(p("onto"))
    run = lambda *a: cli.main([str(x) for x in a], spark)
    assert run("chunk", p("docs"), p("chunks"), "--max-tokens", 32) == 0
    assert run("extract", p("chunks"), p("master"), "--labels", "Cortex, Thalamus") == 0
    assert {r.entity for r in spark.read.parquet(p("master")).collect()} == {"Cortex", "Thalamus"}
    assert run("map", p("master"), p("mapped"), "--ontology", p("onto"), "--csv", p("csv"), "--fail-on-invalid") == cli.REFUSED
    assert run("map", p("master"), p("mapped"), "--ontology", p("onto")) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"refused": 1}
    assert run("audit", p("mapped"), p("audit"), "--fail-on-invalid") == 0
    groups = {r.entity: (r.mention_count, r.ontology_id) for r in spark.read.parquet(p("audit", "groups")).collect()}
    assert groups == {"Cortex": (2, "GO:1"), "Thalamus": (1, None)}
    with pytest.raises(ValueError):
        run("chunk", p("docs"), p("chunks"), "--max-tokens", 5)


def refusing(part):
    """A lookup service named on the command line: it refuses Thalamus."""
    from spanlake.operators.services import HttpError

    if any(t == "Thalamus" for t, _ in part):
        raise HttpError(400, "no")
    return {t: [{"ontology_id": f"SVC:{len(t)}", "ontology_label": t, "ontology": "svc"}] for t, _ in part}


def test_files_artifacts_and_a_service(spark, tmp_path, capsys):
    p = lambda *x: str(tmp_path.joinpath(*x))
    spark.createDataFrame([("a", "Cortex and Thalamus. Cortex again."), ("b", "Nothing.")], "doc_id string, text string").write.parquet(p("docs"))
    spark.createDataFrame([("GO:1", "Thalamus", "go")], "ontology_id string, ontology_label string, ontology string").write.parquet(p("onto"))
    run = lambda *a: cli.main([str(x) for x in a], spark)
    assert run("chunk", p("docs"), p("chunks"), "--files", p("files")) == 0
    assert {(r.doc_id, r.body) for r in artifacts.read_chunks(spark, p("files")).collect()} == {("a", "Cortex and Thalamus. Cortex again."), ("b", "Nothing.")}
    assert run("extract", p("chunks"), p("master"), "--labels", "Cortex, Thalamus", "--artifacts", p("left")) == 0
    texts = {(r.doc, r.part): r.content for r in artifacts.load(spark, p("left", "second_pass")).collect()}
    assert texts["a", "masked_text"] == "****** and ********. ****** again." and len(json.loads(texts["a", "master"])) == 3 and texts["b", "master"] == "[]"
    assert artifacts.read_manifest(p("left", "first_pass"))["labels"] == ["Cortex", "Thalamus"]
    for _ in range(2):
        assert run("map", p("master"), p("mapped"), "--ontology", p("onto"), "--service", "tests.test_cli:refusing", "--store", p("store")) == 0
        assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"refused": 0, "failed_terms": 1}
    got = {r.extracted_text: (r.ontology_uri, r.mapping_backend) for r in spark.read.parquet(p("mapped")).collect()}
    assert got == {"Cortex": ("SVC:6", "service"), "Thalamus": ("GO:1", "local")}
    assert run("audit", p("mapped"), p("audit")) == 0
    one = spark.read.json(p("audit", "summary")).first()
    assert one.totals.total_entity_mentions == 3 and one.validation.ontology.valid_mapped == 3 and one.source.input_kind == "ontology_mapped_entities"
    with pytest.raises(SystemExit):
        run("map", p("master"), p("mapped"), "--ontology", p("onto"), "--service", "tests.test_cli:refusing")


def test_samples_of_pdfs(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF some words")
    with pytest.raises(ValueError, match="is a PDF"):
        config.sample(spark, str(tmp_path))
    assert config.sample(spark, str(tmp_path), 9, lambda raw: raw.decode())[1] == "%PDF some"


def test_save(spark, tmp_path, monkeypatch):
    good = json.dumps([{"entity": "a", "label": "B", "context": "c"}])
    for payload, paper, want in ((good, "p", 0), ("[1]", "p", cli.REFUSED), (good, "../p", cli.REFUSED), ("x", "p", cli.REFUSED)):
        monkeypatch.setattr(sys, "stdin", io.StringIO(payload))
        assert cli.main(["save", str(tmp_path / "out"), "--paper", paper, "--run", "r", "--chunk", "3"], spark) == want
    row = spark.read.json(str(tmp_path / "out")).first()
    assert (row.paper_name, row.run_id, row.chunk_index, row.entity_count, row.entities[0].entity) == ("p", "r", 3, 1, "a")


def test_config(spark, tmp_path, monkeypatch):
    env = tmp_path / ".env"
    env.write_text("# c\nSPANLAKE_A=1\nexport SPANLAKE_B='x y'\nSPANLAKE_C=kept\nbroken\n")
    for k in ("SPANLAKE_A", "SPANLAKE_B"):
        monkeypatch.setenv(k, "gone")
        monkeypatch.delenv(k)
    monkeypatch.setenv("SPANLAKE_C", "mine")
    assert config.load_env(env) == {"SPANLAKE_A": "1", "SPANLAKE_B": "x y"}
    assert (config.env_int("SPANLAKE_A", 5), config.env_int("SPANLAKE_B", 5), config.env_int("SPANLAKE_NONE", 5)) == (1, 5, 5)
    (tmp_path / "papers").mkdir()
    assert config.path_in(f"read {tmp_path}/nothing/x and {tmp_path}/papers please") == str(tmp_path / "papers")
    with pytest.raises(FileNotFoundError):
        config.path_in("read ./no/such/folder")
    with pytest.raises(ValueError):
        config.path_in("no path here")
    (tmp_path / "papers" / "chunk_001.txt").write_text('{"a": 1}\n---\n body text ')
    assert config.sample(spark, str(tmp_path / "papers"), 4)[1] == "body"


def test_service_alive():
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"true\n" if self.path == "/a" else b"starting")

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    assert config.service_alive(url + "/a") and not config.service_alive(url + "/b") and config.service_alive(url + "/b", any_body=True)
    server.shutdown()
    assert not config.service_alive("http://127.0.0.1:9/")

from __future__ import annotations

import pytest

from berth.operators import mapping as mp
from berth.plans import onboarding as onb
from berth.plans import platform
from berth.session import scratch_dir
from berth.sources.layouts import LAYOUTS

FEED = "id,email,amount\n1,a@mail.example.org,2.5\n2,b@mail.example.org,x\n3,c@mail.example.org,4\n"


@pytest.fixture()
def store(spark):
    return onb.Store(spark, scratch_dir(spark, "store"))


def test_full_run(spark, store, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    target = mp.columns_from_ddl(spark.range(1), "ID bigint, amount double")
    done = onb.onboard(spark, store, str(path), target=target)
    assert done.status == "COMPLETED"
    assert done.summary == "Workflow completed with 3 agents executed."
    assert done.frames["profile"].count() == 3
    found = {r["column_name"]: r["label"] for r in done.frames["findings"].collect()}
    assert found == {"email": "EMAIL"}
    assert "COMMENT 'PII - Apply masking policy'" in done.frames["ddl"].collect()[0]["ddl"]
    result = done.frames["result"].collect()[0]
    assert result["pii_risk_level"] == "LOW" and result["data_quality_score"] == 100.0
    assert [r["ID"] for r in done.frames["loaded"].orderBy("ID").collect()] == [1, 3]
    assert done.frames["rejected"].count() == 1
    states = {r["agent_name"]: r for r in onb.step_states(store).collect()}
    assert {n: r["status"] for n, r in states.items()} == dict.fromkeys(
        ["PROFILING", "DICTIONARY", "MAPPING"], "COMPLETED"
    )
    assert states["MAPPING"]["summary"] == "Generated 3 field mappings with 4 DBT models."
    assert onb.workflow_status(store, done.workflow_id).collect()[0]["status"] == "COMPLETED"
    assert onb.dictionary_state(store).count() == 3


def test_failed_run_is_logged(spark, store, tmp_path):
    lost = onb.onboard(spark, store, str(tmp_path / "gone.csv"))
    assert lost.status == "FAILED" and lost.summary == "Error: PATH_NOT_FOUND"
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    kept = onb.onboard(spark, store, str(path), workflow_type=onb.PROFILING_ONLY)
    assert set(kept.frames) == {"profile", "findings", "issues", "history", "result", "metrics"}
    states = {r["workflow_id"]: r["status"] for r in onb.workflow_states(store).collect()}
    assert states == {lost.workflow_id: "FAILED", kept.workflow_id: "COMPLETED"}
    listed = onb.list_workflows(store, 5, "FAILED").collect()
    assert [r["workflow_id"] for r in listed] == [lost.workflow_id]
    assert onb.workflow_status(store, "nobody").count() == 0
    with pytest.raises(ValueError):
        onb.onboard(spark, store, str(path), workflow_type="OTHER")


def test_later_runs_keep_what_is_known(spark, store, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    onb.onboard(spark, store, str(path))
    first = {r["column_name"]: r for r in onb.dictionary_state(store).collect()}
    path.write_text(FEED.replace("amount", "price"))
    done = onb.onboard(spark, store, str(path))
    rows = {r["column_name"]: r for r in onb.dictionary_state(store).collect()}
    assert set(rows) == {"id", "email", "amount", "price"}
    assert rows["id"]["created_at"] == first["id"]["created_at"] < rows["id"]["updated_at"]
    assert rows["amount"]["updated_at"] == first["amount"]["updated_at"]
    assert rows["price"]["created_at"] == rows["price"]["updated_at"]
    kinds = [(r["agent_name"], r["metric_type"]) for r in done.frames["metrics"].collect()]
    assert len(kinds) == len(set(kinds)) == 6


def test_text_is_parsed_once_for_all_steps(spark, store, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    done = onb.onboard(spark, store, str(path))
    for name in ("loaded", "profile"):
        plan = done.frames[name]._jdf.queryExecution().executedPlan().toString()
        assert "FileScan csv" not in plan
    assert store.read("landing").count() == 3


def test_a_run_fills_the_platform_tables(spark, store, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    done = onb.onboard(spark, store, str(path))
    lost = onb.onboard(spark, store, str(tmp_path / "gone.csv"))
    runs = {r["workflow_id"]: r for r in platform.read_table(store, "workflow_executions").collect()}
    assert runs[done.workflow_id]["status"] == "COMPLETED"
    assert runs[done.workflow_id]["agent_sequence"] == ["PROFILING", "DICTIONARY", "MAPPING"]
    assert (runs[lost.workflow_id]["status"], runs[lost.workflow_id]["error_message"]) == (
        "FAILED", "Error: PATH_NOT_FOUND",
    )
    steps = platform.read_table(store, "agent_execution_log")
    assert steps.count() == 4 and steps.filter("status = 'FAILED'").count() == 1
    ids = set()
    for name in LAYOUTS:
        rows = platform.read_table(store, name)
        assert rows.columns == [c.split(" ")[0] for c in LAYOUTS[name].split(", ")]
        assert rows.count() > 0, name
        ids |= {(name, r[0]) for r in rows.collect()}
    assert len(ids) == sum(platform.read_table(store, n).count() for n in LAYOUTS)
    (profile,) = platform.read_table(store, "agent_profiling_history").collect()
    assert profile["workflow_id"] == done.workflow_id and profile["pii_detected"] == ["email"]


def test_runs_merge_into_the_curated_table(spark, store, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    first = onb.onboard(spark, store, str(path), keys=["id"])
    assert {r["id"]: r["email"] for r in first.frames["curated"].collect()} == {
        1: "a@mail.example.org", 2: "b@mail.example.org", 3: "c@mail.example.org",
    }
    assert {(r["column_name"], r["test"]): r["failures"] for r in first.frames["tests"].collect()}[("id", "unique")] == 0
    path.write_text("id,email,amount,more\n2,new@mail.example.org,2.5,x\n,lost@mail.example.org,1,y\n4,d@mail.example.org,1,y\n")
    again = onb.onboard(spark, store, str(path), keys=["id"])
    assert again.status == "COMPLETED", again.summary
    rows = {r["id"]: (r["email"], r["more"]) for r in again.frames["curated"].collect()}
    assert rows[2] == ("new@mail.example.org", "x") and rows[1] == ("a@mail.example.org", None) and len(rows) == 4
    assert again.frames["rejected"].select("violations").collect()[0][0] == ["id is given"]


def test_only_approved_proposals_create_tables(spark, store, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(FEED)
    done = onb.onboard(spark, store, str(path))
    (proposal,) = onb.proposals(store).collect()
    assert proposal["approval_status"] == "PENDING"
    landing = store.read("landing").drop("run")
    name = proposal["proposal_id"]
    with pytest.raises(ValueError, match="not approved"):
        onb.execute_proposal(store, name, landing)
    onb.decide(store, name, "REJECTED", "ann")
    onb.decide(store, name, "APPROVED", "bo")
    (state,) = onb.proposals(store).collect()
    assert (state["approval_status"], state["approved_by"]) == ("APPROVED", "bo")
    created = onb.execute_proposal(store, name, landing)
    assert created.count() == 3 and created.columns == ["id", "email", "amount"]
    long = landing.withColumn("id", onb.F.lit("many"))
    with pytest.raises(ValueError, match="id"):
        onb.execute_proposal(store, name, long)
    with pytest.raises(ValueError):
        onb.decide(store, name, "MAYBE", "ann")
    assert done.status == "COMPLETED"

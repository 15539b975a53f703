"""The chain over arriving files against one batch of all of them."""

import json
import random
import shutil

import pytest

from ticket_topics.operators.lexicon import induce_lexicon
from ticket_topics.plans import arrivals, jobs
from ticket_topics.sources import stages

THEMES = (
    "card charge fee account bank statement",
    "loan house mortgage payment escrow rate",
    "theft police report fraud dispute identity",
)


def records(begin, end):
    rng = random.Random(begin)
    return [
        {"_index": "i", "_type": "t", "_id": str(i), "_score": 0.0,
         "_source": {"complaint_what_happened": " ".join(rng.choices(THEMES[i % 3].split(), k=9))}}
        for i in range(begin, end)
    ]


def lines(rows):
    return "".join(json.dumps(r) + "\n" for r in rows)


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("fitted")
    source = base / "history.json"
    source.write_text(lines(records(0, 60)))
    words = [(w, "NN", w) for t in THEMES for w in t.split()]
    lexicon = induce_lexicon(spark.createDataFrame(words, "form string, tag string, lemma string"))
    catalog = stages.StageCatalog(str(base / "stages"))
    jobs.preprocess_job(spark, str(source), lexicon, catalog)
    jobs.label_job(spark, str(source), catalog, "relabel")
    trained, _ = jobs.train_job(spark, str(source), catalog)
    return lexicon, catalog, trained.model


def content(chain, spark, name):
    rows = chain.table(spark, name).drop("batch", "offset", "file")
    return sorted(map(repr, rows.select(*sorted(rows.columns)).collect()))


def test_three_arrivals_equal_one_batch_and_a_killed_one_changes_nothing(spark, fitted, tmp_path):
    def chain(name, folder):
        made = arrivals.ArrivingChain(*fitted, str(tmp_path / name / "out"), str(tmp_path / name / "checkpoint"))
        return made, lambda: made.run(arrivals.new_files(spark, str(tmp_path / folder)))

    parts = [lines(records(0, 20)), lines(records(20, 21)) + "{broken\n" + lines([{"_id": "x"}]), lines(records(21, 40))]
    for folder in ("in", "all"):
        (tmp_path / folder).mkdir()
    step, run = chain("steps", "in")
    for i, part in enumerate(parts):
        (tmp_path / "in" / f"a[{i}],{{b}} c.json").write_text(part)
        (tmp_path / "all" / f"{i}.json").write_text(part)
        if i == 1:
            # a batch that dies behind its third table leaves no trace in what is read
            before = content(step, spark, "labeled")
            step.classifier = None
            with pytest.raises(Exception):  # noqa: B017
                run()
            assert content(step, spark, "labeled") == before
            step.classifier = fitted[2]
        run()
    whole, run_all = chain("whole", "all")
    run_all()
    for name in arrivals.STAGES:
        assert content(step, spark, name) == content(whole, spark, name), name
    assert len(content(step, spark, "scored")) == 40 and len(content(step, spark, "malformed")) == 1
    assert sorted((r.batch, r.n_malformed, r.n_texts) for r in step.commits(spark).collect()) == [
        (0, 0, 20), (1, 1, 1), (2, 0, 19)
    ]
    # a committed batch that is tried again stays as it is, and others may not take its place
    done = {f for f in (tmp_path / "steps" / "out").rglob("*.parquet")}
    for part in ("offsets", "commits"):
        for file in (tmp_path / "steps" / "checkpoint" / part).glob("*2*"):
            if part == "commits":
                shutil.move(file, tmp_path / f"moved-{file.name}")
    run()
    assert {f for f in (tmp_path / "steps" / "out").rglob("*.parquet")} == done
    with pytest.raises(ValueError):
        step.advance(spark.createDataFrame([("other.json",)], "path string"), 0)
    with pytest.raises(ValueError):
        step.table(spark, "other")

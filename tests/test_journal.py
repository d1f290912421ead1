import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fundglean.operators import calls, journal
from fundglean.operators.candidates import reduce_cascade

SENT = "{SEC_FILING_SNIPPET}"
TYPE = "cik string, accession_number string, candidates array<struct<ordinal:int,method:string,chunks:array<int>,text:string>>"
FOUND, NONE = '{"trustees": [{}, {}]}', '{"trustees": []}'


def filings(spark, data):
    rows = [(f, "a", [(i, f"m{i}", [i], t) for i, t in enumerate(texts)]) for f, texts in data.items()]
    return spark.createDataFrame(rows, TYPE)


def model(log, die_at=None):
    """Notes each prompt it answers; prompts that say so are accepted. At ``die_at`` the process ends."""

    def ask(prompts):
        out = []
        for p in prompts:
            if die_at and die_at in p and not os.path.exists(f"{log}.died"):
                open(f"{log}.died", "w").close()
                os._exit(3)
            with open(log, "a") as f:
                f.write(p + "\n")
            out.append(FOUND if "yes" in p else NONE)
        return out

    return ask


def sent(log):
    return Counter(open(log).read().split("\n")[:-1]) if os.path.exists(log) else Counter()


def results(df):
    return {r.cik: (r.selected_chunks, r.n_trustee, r.error) for r in reduce_cascade(df).collect()}


DATA = {
    "a": ["a0 yes", "a1 yes"],
    "b": ["b0", "b1 yes", "b2"],
    "c": ["c0", "c1"],
    "d": ["same", "d1 yes"],
    "e": ["same", "e1 yes"],
}
WANT = {"a": ([0], 2, None), "b": ([1], 2, None), "c": ([1], 0, None), "d": ([1], 2, None), "e": ([1], 2, None)}


def test_each_prompt_is_sent_once(spark, tmp_path):
    log, kept = str(tmp_path / "log"), str(tmp_path / "journal")
    df = filings(spark, DATA)
    for run in ("one", "two"):
        got = journal.ask_in_turn(df, model(log), kept, "m", run, SENT, prompts_per_call=2)
        assert results(got) == WANT
        assert sent(log) == Counter(["a0 yes", "b0", "b1 yes", "c0", "c1", "same", "d1 yes", "e1 yes"])
    without = calls.ask_in_turn(df, model(str(tmp_path / "other")), SENT)
    assert results(without) == WANT
    # another model has answers of its own
    journal.ask_in_turn(df, model(log), kept, "m2", "one", SENT)
    assert sent(log)["a0 yes"] == 2


def test_a_task_killed_half_way_loses_no_answer(spark, tmp_path):
    """The first run ends with the process that calls; the second sends only the rest."""
    log, kept = str(tmp_path / "log"), str(tmp_path / "journal")
    df = filings(spark, {str(i): [f"p{i} {'yes' if i % 3 else 'no'}", f"q{i} yes"] for i in range(40)})
    ask = model(log, die_at="p17 ")
    with pytest.raises(Exception, match="crashed"):
        journal.ask_in_turn(df, ask, kept, "m", "one", SENT, prompts_per_call=1)
    before = sent(log)
    assert before and max(before.values()) == 1 and "p17 yes" not in before
    answered = journal.answers_of(spark, kept, "m").count()
    got = results(journal.ask_in_turn(df, ask, kept, "m", "two", SENT, prompts_per_call=1))
    assert got == {str(i): ([0 if i % 3 else 1], 2, None) for i in range(40)}
    # a task that was under way when the job ended may have sent without writing
    again = {p: n for p, n in sent(log).items() if n > 1}
    assert sum(n - 1 for n in again.values()) == sum(before.values()) - answered
    assert set(sent(log)) == {f"p{i} {'yes' if i % 3 else 'no'}" for i in range(40)} | {
        f"q{i} yes" for i in range(0, 40, 3)
    }


def test_errors_are_asked_again(spark, tmp_path):
    kept = str(tmp_path / "journal")
    df = filings(spark, {"a": ["a0 yes"], "b": ["bad yes"]})

    def failing(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("no luck")
        return [FOUND] * len(prompts)

    got = results(journal.ask_in_turn(df, failing, kept, "m", "one", SENT))
    assert got == {"a": ([0], 2, None), "b": ([0], 0, "RuntimeError: no luck")}
    log = str(tmp_path / "log")
    got = results(journal.ask_in_turn(df, model(log), kept, "m", "two", SENT))
    assert got == {"a": ([0], 2, None), "b": ([0], 2, None)} and sent(log) == Counter(["bad yes"])


def test_no_candidates(spark, tmp_path):
    df = filings(spark, {"a": ["x"]}).where(F.lit(False))
    got = journal.ask_in_turn(df, model(str(tmp_path / "log")), str(tmp_path / "j"), "m", "r", SENT)
    assert got.collect() == []

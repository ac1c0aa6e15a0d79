from pyspark.sql import functions as F

from folio.operators import enrich as E
from folio.operators.routing import MODEL_LIMITS, context_limit

BODIES = [
    ('{"summary":"S","topics":[" a ","B",""]}', "S", ["a", "B"], True, "S", ["a", "B"], True),
    ('{"summary":"","topics":[]}', E.NO_SUMMARY, [], True, "", [], True),
    ('{"summary":null,"topics":null}', E.NO_SUMMARY, [], True, "", [], False),
    ('{"topics":["x"]}', E.FAILED, [], False, E.NO_SUMMARY, ["x"], True),
    ('{"summary":"only"}', E.FAILED, [], False, "only", [], True),
    ('{"summary":"S","topics":["a",1]}', E.FAILED, [], False, None, [], False),
    ('not json', E.FAILED, [], False, None, [], False),
    ('[1,2]', E.FAILED, [], False, None, [], False),
    ('  {"summary":"pad","topics":["t"]}  ', "pad", ["t"], True, "pad", ["t"], True),
    ('{"summary":0,"topics":0}', E.NO_SUMMARY, [], True, None, [], False),
    ('{"summary":"s","topics":"a b"}', "s", ["a", "b"], True, "s", ["a", "b"], True),
    ('{"summary":"s","topics":{"z":1," y ":2}}', "s", ["z", "y"], True, "s", ["z", "y"], True),
    ('{"summary":"s","topics":{}}', "s", [], True, "s", [], True),
    ('{"summary":"s","topics":""}', "s", [], True, "s", [], True),
    ('{"summary":"s","topics":false}', "s", [], True, None, [], False),
    ('{"summary":"s","topics":5}', E.FAILED, [], False, None, [], False),
]


def test_parse_single_and_part(spark):
    df = spark.createDataFrame([(i, b[0]) for i, b in enumerate(BODIES)], "part int, body string")
    single = {r.part: r for r in E.parse_single(df).collect()}
    part = {r.part: r for r in E.parse_part(df).collect()}
    for i, (_, s_sum, s_top, s_ok, p_sum, p_top, p_ok) in enumerate(BODIES):
        assert (single[i].summary, list(single[i].topics), single[i].ok) == (s_sum, s_top, s_ok), BODIES[i][0]
        want = p_sum if p_ok else f"Could not generate summary for part {i}."
        assert (part[i].summary, list(part[i].topics), part[i].ok) == (want, p_top, p_ok), BODIES[i][0]


def test_merges(spark):
    rows = [("r", 2, "second", ["Beta", "gamma"]), ("r", 1, " first ", ["alpha", "BETA"]), ("q", 1, "only", [])]
    df = spark.createDataFrame(rows, "request_id string, part int, summary string, topics array<string>")
    ms = {r.request_id: r for r in E.merge_summaries(df).collect()}
    assert ms["r"].merge_prompt == "Section 1:  first \n\nSection 2: second"
    assert ms["r"].summary == "first  second"
    mt = {r.request_id: list(r.topics) for r in E.merge_topics(df).collect()}
    assert mt == {"r": ["alpha", "BETA", "gamma"], "q": []}


def test_merge_replies(spark):
    reqs = spark.createDataFrame([(r, p, "parts") for r in "abcd" for p in (1, 2)] + [("e", 1, "single")],
                                 "request_id string, part int, route string")
    resp = spark.createDataFrame([(r, p, f'{{"summary":"s{p}","topics":["T"]}}') for r in "abcd" for p in (1, 2)],
                                 "request_id string, part int, body string")
    replies = spark.createDataFrame([("a", " whole "), ("b", ""), ("c", None), ("e", "not read")], "request_id string, body string")
    out = E.enrich(reqs, resp, replies)
    assert {r.request_id: (r.summary, r.topics) for r in out.collect()} == {
        "a": ("whole", ["T"]), "b": (E.FAILED_FINAL, ["T"]), "c": (E.FAILED_FINAL, ["T"]), "d": ("s1 s2", ["T"]), "e": (E.FAILED, [])}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_context_limit_rules(spark):
    cases = dict(MODEL_LIMITS)
    cases.update({"GPT-4O-Custom": 128000, "my-gpt-4-1106-x": 128000, "gpt-4-32k": 8192, "gpt-3.5-turbo-instruct": 16385,
                  "code-davinci-edit": 8001, "text-davinci-001": 4097, "other": 4096, "GPT-4": 8192})
    df = spark.createDataFrame(list(cases.items()), "m string, want int")
    assert all(r.got == r.want for r in df.select("want", context_limit(F.col("m")).alias("got")).collect())


def test_prompt_requests_parts(spark):
    df = spark.createDataFrame([("a", "single", "body", None), ("b", "parts", "x", ["p1", "p2"])],
                               "id string, route string, content string, parts array<string>")
    reqs = {(r.request_id, r.part): r for r in E.prompt_requests(df).collect()}
    assert "(Part" not in reqs[("a", 1)].prompt and reqs[("a", 1)].prompt.endswith("body")
    assert "(Part 2 of 2)" in reqs[("b", 2)].prompt and reqs[("b", 2)].parts == 2

import json

import pytest
from pyspark.sql import functions as F

from catalogue_enrich.operators.infer import RateLimited, call_model
from catalogue_enrich.operators.normalize import from_documents
from catalogue_enrich.operators.prompt import Prompts
from catalogue_enrich.operators.report import flat_results, run_metrics, unresolved, without_images
from catalogue_enrich.plans.enrichment import enrich_documents
from tests.articles import MISSING, RESULT, article, attribute, raw, value


def make_fetch():
    def fetch(url):
        if "fail" in url:
            raise OSError("no")
        return url.encode()

    return fetch


def echo_client(**replies):
    """A client that answers by attribute id, which the prompt starts with."""

    def make():
        tries = {}

        def client(messages, wants_list, temperature, max_tokens):
            assert [m["role"] for m in messages] == ["system", "user"] and (temperature, max_tokens) == (0.0, 50)
            text, *images = messages[1]["content"]
            assert images and all(i["image_url"]["url"].startswith("data:image/jpeg;base64,") for i in images)
            key = "farbe" if wants_list else text["text"]
            tries[key] = tries.get(key, 0) + 1
            reply = replies.get(key, '{"response": "%s/%d/%s"}' % (key, len(images), messages[0]["content"]))
            if isinstance(reply, list):
                reply = reply[min(tries[key], len(reply)) - 1]
            if isinstance(reply, type):
                raise reply("told so")
            return reply

        return client

    return make


PROMPTS = Prompts(attribute="{attribute_id}", colour="colour", system_attribute="S", system_colour="C")


def run(spark, documents, client=None, **options):
    pairs = [(f"{i}.json", d) for i, d in enumerate(documents)]
    waits = options.pop("waits", {})
    options.setdefault("validate", False)
    answerer = call_model(client or echo_client(), sleep=lambda s: None, **waits)
    return enrich_documents(raw(spark, pairs), make_fetch, answerer, prompts=PROMPTS, **options)


def documents_of(done):
    return {r["source_file"]: json.loads(r["enriched"]) for r in done.documents.collect()}


def test_whole_chain(spark):
    only_main = {"Freisteller Back": MISSING, "Modellbild": None}
    attributes = [attribute("x", [value("a")]), attribute("farbe"), attribute("farbHex", None), attribute("x")]
    sources = [
        article(0, **{"Klassifikations-Attribute": attributes}),
        article(1, Hauptbild="http://img/fail"),
        article(2, Hauptbild="http://img/fail", **only_main),
        article(3, Hauptbild="", **only_main),
        article(4, Klassifikation=[]),
        article(5, **{"Klassifikations-Attribute": MISSING}),
    ]
    colours = '{"response": ["#ff0000"]}'
    done = run(spark, sources, echo_client(farbe=colours), parallelism=3)
    want = json.loads(json.dumps(sources))
    for a, r in zip(want[0]["Klassifikations-Attribute"], ["x/3/S", ["#ff0000"], "farbHex/3/S", "x/3/S"]):
        a[RESULT] = r
    for a, r in zip(want[1]["Klassifikations-Attribute"], ["bauart/2/S", ["#ff0000"]]):
        a[RESULT] = r
    for a in want[2]["Klassifikations-Attribute"]:
        a[RESULT] = None
    assert documents_of(done) == {f"{i}.json": want[i] for i in (0, 1, 2, 3, 5)}
    assert [(r["source_file"], r["reason"]) for r in done.quarantine.collect()] == [("4.json", "category_missing")]
    assert {tuple(r) for r in done.ledger.collect()} == {
        ("1", None, "http://img/fail"), ("1", "F1", "http://img/fail"),
        ("2", None, "http://img/fail"), ("2", "F2", "http://img/fail"), ("3", "F3", "[]"),
    }
    metrics = {r["metric"]: r["value"] for r in done.metrics.collect()}
    assert metrics == {
        "articles": 5, "attributes": 10, "model_calls": 6, "inferred": 3, "kept": 1, "nulled": 1, "failed": 0,
    }
    left = {r["attribute_id"]: (r["n_unresolved"], r["n"]) for r in unresolved(flat_results(done.articles)).collect()}
    assert left == {"x": (0, 2), "farbe": (1, 4), "farbHex": (0, 1), "bauart": (1, 3)}
    assert [tuple(r) for r in without_images(done.articles).collect()] == [("Damen", 1)]


@pytest.mark.parametrize(
    "reply, result",
    [("not json", "not json"), ('{"answer": 1}', '{"answer": 1}'), ('{"response": null}', None), ('{"response": 5}', 5)],
)
def test_raw_answers_are_written(spark, reply, result):
    done = run(spark, [article(0)], echo_client(bauart=reply))
    assert documents_of(done)["0.json"]["Klassifikations-Attribute"][0][RESULT] == result


def test_rate_limit_is_retried(spark):
    client = echo_client(bauart=[RateLimited, RateLimited, '{"response": "ok"}'])
    done = run(spark, [article(0)], client)
    assert documents_of(done)["0.json"]["Klassifikations-Attribute"][0][RESULT] == "ok"


@pytest.mark.parametrize(
    "reply, reason",
    [
        (KeyError, "KeyError: 'told so'"),
        ("[1]", "answer is not a JSON object"),
        (None, "answer is not a JSON object"),
    ],
)
def test_failed_calls_are_quarantined(spark, reply, reason):
    replies = {"bauart": [reply]} if reply is None else {"bauart": reply}
    done = run(spark, [article(0), article(1, **{"Klassifikations-Attribute": []})], echo_client(**replies), waits={"max_tries": 3})
    assert [(r["source_file"], r["reason"]) for r in done.quarantine.collect()] == [("0.json", reason)]
    assert set(documents_of(done)) == {"1.json"}


def test_a_lasting_rate_limit_fails_the_job(spark):
    with pytest.raises(Exception, match="still limited after 3 calls"):
        run(spark, [article(0)], echo_client(bauart=RateLimited), waits={"max_tries": 3})


def test_calls_are_spread_by_their_number(spark):
    def make():
        from pyspark import TaskContext

        def client(messages, **_):
            return json.dumps({"response": str(TaskContext.get().partitionId())})

        return client

    sources = [article(i) for i in range(100)]
    sources += [article(i, Hauptbild="http://img/fail", **{"Freisteller Back": MISSING, "Modellbild": None}) for i in range(100, 150)]
    done = run(spark, sources, make)
    tasks = {
        a[RESULT] for d in documents_of(done).values() for a in d["Klassifikations-Attribute"] if isinstance(a[RESULT], str)
    }
    assert len(tasks) >= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_two_colours_of_a_product(spark):
    def make_bytes():
        def fetch(url):
            if "fail" in url:
                raise OSError("no")
            return url.encode()

        return fetch

    def make():
        def client(messages, **_):
            return json.dumps({"response": messages[1]["content"][1]["image_url"]["url"]})

        return client

    one = {"Freisteller Back": MISSING, "Modellbild": None, "ProduktID": "1"}
    sources = [
        article(0, Hauptbild="http://img/fail", FarbID="F1", **one),
        article(1, Hauptbild="http://img/two", FarbID="F2", **one),
    ]
    from catalogue_enrich.functions.encoding import data_url
    from catalogue_enrich.operators.images import attach_images, branch
    from catalogue_enrich.operators.normalize import from_struct
    from catalogue_enrich.schema import ARTICLE

    rows = [tuple(s.get(f) if isinstance(s.get(f), (str, type(None))) else None for f in ARTICLE.names) for s in sources]
    articles = from_struct(spark.createDataFrame(rows, ARTICLE), ["ProduktID", "FarbID"])
    images = spark.createDataFrame([("http://img/fail", 1, False), ("http://img/two", 1, True)], "url string, n_uses long, ok boolean")
    joined = attach_images(articles, images).withColumn("branch", branch())
    assert {r.colour_id: r.branch for r in joined.collect()} == {"F1": "nulled", "F2": "inferred"}

    done = run(spark, sources, make)
    got = documents_of(done)
    want = spark.range(1).select(data_url(F.encode(F.lit("http://img/two"), "UTF-8")).alias("u")).first().u
    assert {a[RESULT] for a in got["0.json"]["Klassifikations-Attribute"]} == {None}
    assert {str(a[RESULT]) for a in got["1.json"]["Klassifikations-Attribute"]} == {want}


def test_attributes_of_an_article_can_be_asked_at_once(spark, folder):
    def make():
        import threading

        together = threading.Barrier(3, timeout=60)  # all three calls must be under way

        def client(messages, **_):
            together.wait()
            return json.dumps({"response": messages[1]["content"][0]["text"]})

        return client

    attributes = [attribute(i, []) for i in "abc"]
    sources = [article(i, **{"Klassifikations-Attribute": attributes}) for i in range(3)]
    done = run(spark, sources, make, waits={"concurrency": 3})
    for document in documents_of(done).values():
        assert [a[RESULT] for a in document["Klassifikations-Attribute"]] == list("abc")


def test_failed_calls_can_fail_the_job(spark):
    with pytest.raises(Exception, match="model call failed"):
        run(spark, [article(0)], echo_client(bauart=KeyError), waits={"on_error": "fail"})
    with pytest.raises(ValueError):
        call_model(echo_client(), on_error="nonsense")


@pytest.mark.parametrize(
    "document, reply, reason",
    [
        ("broken", "x", "invalid_json"),
        (article(0, Klassifikation=[]), "x", "category_missing"),
        (article(0), "[1]", "answer is not a JSON object"),
        (article(0), KeyError, "told so"),
    ],
)
def test_errors_can_fail_the_job(spark, document, reply, reason):
    with pytest.raises(Exception, match=reason):
        run(spark, [article(1), document], echo_client(bauart=reply), on_error="fail")
    assert len(documents_of(run(spark, [article(1)], on_error="fail"))) == 1


def test_lenient_run(spark):
    sources = [article(0, Klassifikation=[]), "broken"]
    done = run(spark, sources, strict=False)
    assert set(documents_of(done)) == {"0.json"}
    assert [r["reason"] for r in done.quarantine.collect()] == ["invalid_json"]


def test_metrics_of_nothing(spark):
    rows = run(spark, ["broken"]).articles
    assert {r["metric"]: r["value"] for r in run_metrics(rows).collect()}["attributes"] == 0
    assert from_documents(raw(spark, [])).where(F.lit(True)).count() == 0

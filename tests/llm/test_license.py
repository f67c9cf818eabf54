from txguard.llm import license_scan

APACHE = "Licensed under the Apache License, Version 2.0."


def rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_base_places_and_labels(documents, clashing):
    found = rows(license_scan.scan(clashing(documents(
        (1, "MIT License, mit license MIT LICENSE"), (2, "cc by cc"), (3, None), (4, ""), (5, "amit license"), (6, "gnu general public license apache license")))))
    assert (found[1]["n_words"], found[1]["n_base"], found[1]["first_word"], found[1]["last_word"], found[1]["base_labels"]) == (6, 3, 0, 4, "mit")
    assert found[2]["base_labels"] == "cc-by" and found[2]["score"] == 0.5
    assert found[3] == {"doc_id": 3, "n_words": 0, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0}
    assert found[4]["n_base"] == 0 and found[5]["n_base"] == 0
    assert found[6]["base_labels"] == "apache,gpl" and found[6]["last_word"] == 4


def test_templates_add_labels_in_any_place(documents):
    found = rows(license_scan.scan(documents(
        (1, "word " * 5000 + APACHE + " word" * 10), (2, APACHE + " " + APACHE), (3, "Licensed under the Apache License"),
        (4, "Licensed, under the -- Apache License? version 2!0"))))
    assert found[1]["labels"] == "apache,apache-2.0" and found[1]["score"] == 1.0
    assert found[2]["labels"] == "apache,apache-2.0" and found[2]["n_base"] == 2
    assert found[3]["labels"] == "apache" and found[3]["score"] < license_scan.COVERAGE
    assert found[4]["score"] == 1.0


def test_neighbouring_diagonals_are_one_span(spark, documents):
    text = license_scan.TEMPLATES[3][1].replace("hereby granted", "hereby kindly granted")
    found = rows(license_scan.scan(documents((1, text))))
    assert found[1]["labels"] == "mit" and 0.75 < found[1]["score"] <= 1.0


def test_repeated_rows_and_empty_table(documents):
    assert license_scan.scan(documents((1, APACHE), (1, APACHE), (None, APACHE))).count() == 3
    assert license_scan.scan(documents()).count() == 0

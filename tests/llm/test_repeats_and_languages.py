"""Repeated numbers by a field trained on real documents; pages in languages without a stop-word list."""

import pyarrow.parquet as pq
import pytest

from fleetpulse.llm import html_text, pii_crf, toxicity_gru


@pytest.fixture(scope="module")
def field():
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.1/documents.parquet").column("text").to_pylist()]
    some = [t for t in texts if any(c in t for c in "0123456789@")][:1500]
    return pii_crf.fit(pii_crf.Batch([pii_crf.graph_of(t, pii_crf.base_spans(t)) for t in some]))


def spans(field, text):
    return [(text[s:e], pii_crf.KINDS[k - 1]) for s, e, k in pii_crf.find_all([text], field, 0.9)[0][1]]


def test_repeated_numbers_in_other_notations(field):
    assert spans(field, "call +1 415 555 2671 or 4155552671 now, again 415-555-2671.") == [
        ("+1 415 555 2671", "phone"), ("4155552671", "phone"), ("415-555-2671", "phone")]
    assert spans(field, "4155552671, that is +1 415 555 2671, or 415-555-2671") == [
        ("4155552671", "phone"), ("+1 415 555 2671", "phone"), ("415-555-2671", "phone")]
    far = " ".join(f"word{k} {1000 + k}" for k in range(300))
    assert spans(field, f"+1 415 555 2671 {far} 4155552671 {far} 4155552671")[1:] == [("4155552671", "phone")] * 2


def test_parts_of_a_number_elsewhere_are_nothing(field):
    assert spans(field, "card 4111 1111 2024 0009 in 2024, order 4111, year 2024") in (
        [], [("4111 1111 2024 0009", "card")])
    assert spans(field, "no finding 4155552671 and 4155552671 alone") == []


def test_spans_do_not_depend_on_the_texts_beside(field):
    texts = ["+1 415 555 2671 x 4155552671", "4155552671 4155552671 10.0.0.1 and 10.0.0.1", "a@b.co b a@b.co 77"] * 3
    assert pii_crf.find_all(texts, field, 0.9) == [pii_crf.find_all([t], field, 0.9)[0] for t in texts]


PARAGRAPHS = {
    "ru": "Это первый абзац статьи на русском языке, в котором достаточно много слов для проверки правил извлечения.",
    "zh": "这是一篇中文文章的第一段内容，其中包含足够多的文字，用来检验正文提取规则是否能够在没有停用词表的情况下正常工作，并且保留全部段落，不会丢失任何一个句子或者标题。",
    "ar": "هذه هي الفقرة الأولى من المقال باللغة العربية وفيها ما يكفي من الكلمات للتحقق من قواعد استخراج النص الرئيسي.",
    "el": "Αυτή είναι η πρώτη παράγραφος του άρθρου στα ελληνικά και έχει αρκετές λέξεις για τον έλεγχο των κανόνων.",
    "pl": "Jest to pierwszy akapit artykułu, który zawiera wystarczająco wiele słów, żeby sprawdzić reguły wydobywania treści.",
}


@pytest.mark.parametrize("lang", sorted(PARAGRAPHS))
def test_languages_without_stop_words(lang):
    p = PARAGRAPHS[lang]
    page = f"<nav><a href=a>{p[:20]}</a></nav><div><h1>{p[:15]}</h1><p>{p}</p><p>{p}</p></div><div><a href=b>{p}</a></div>"
    assert html_text.main_text(page) == "\n".join([p[:15], p, p])


def test_closing_paragraph_after_a_list_of_links():
    good = "This is the first paragraph of the article and it has lots of the words that are stop words in it."
    page = f"<article><p>{good}</p><ul><li><a href=a>Source one</a></li><li><a href=b>Source two</a></li></ul><p>The end.</p></article>"
    assert html_text.main_text(page) == f"{good}\nThe end."


def test_long_words_are_cut_into_overlapping_pieces():
    assert toxicity_gru.words_of("a " + "b" * 32) == ["a", "b" * 32]
    cut = toxicity_gru.words_of("x" + "".join(chr(97 + k % 26) for k in range(100)))
    assert len(cut) == 6 and all(len(w) <= 32 for w in cut) and cut[0][16:] == cut[1][:16]

import pytest

from appfacet.llm import line_quality


@pytest.mark.parametrize("shared, own", [(10, 2), (10, 1), (20, 1)])
def test_lines_shared_by_different_documents_are_frequent(documents, prose, shared, own):
    common = prose(shared, 12 * shared)
    rows = [(i, common + "\n" + prose(500 + i, 12 * own)) for i in range(60)] + [(100, common)] * 40
    out = line_quality.line_quality(documents(rows)).collect()
    assert len(out) == 100 and not any(r.kept for r in out)
    keys = {line_quality.line_key(words) for words in line_quality.normal_lines(common)}
    assert all(keys <= {*r.removed_lines} for r in out)


def test_a_line_on_many_documents_is_frequent_whatever_its_share(documents, prose):
    rows = [(i, prose(i, 60) + ("\nall rights reserved by us" if i < 45 else "")) for i in range(90)]
    few = line_quality.line_quality(documents(rows), share=0.6, most_documents=45).collect()
    many = line_quality.line_quality(documents(rows), share=0.6, most_documents=44).collect()
    assert not any(r.removed_lines for r in few)
    assert {r.doc_id for r in many if r.removed_lines} == set(range(45))

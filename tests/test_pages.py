"""Memory of the page parser's Python workers."""

import tracemalloc

import pyarrow as pa

from folioloom.plans import html as H


def test_few_pages_are_objects_at_once():
    """A batch of many pages takes little more Python memory than one of few; a null page is an empty one."""
    page = "<div class='a'>" + "".join(f"<p>text {k}<b>bold</b></p>" for k in range(60)) + "</div>"

    def peak(pages):
        tracemalloc.start()
        out = H.parsed.func(pa.array(pages, pa.string()))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(out) == len(pages)
        return out, most

    few, small = peak([page] * 32)
    many, large = peak([page] * 320 + [None])
    assert large < 2 * small
    assert many[319] == few[0] and len(many[320]["nodes"]) == 1 and not len(H.parsed.func(pa.array([], pa.string())))

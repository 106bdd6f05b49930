"""Writes small .pptx decks: what `decks` reads, for tests and round trips."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape, quoteattr

A, P = "http://schemas.openxmlformats.org/drawingml/2006/main", "http://schemas.openxmlformats.org/presentationml/2006/main"
C, R = "http://schemas.openxmlformats.org/drawingml/2006/chart", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
LINKS = "http://schemas.openxmlformats.org/package/2006/relationships"
EMU = 12_700


def _frame(x: float, y: float, w: float, h: float, tag: str = "a:xfrm") -> str:
    return f'<{tag}><a:off x="{round(x * EMU)}" y="{round(y * EMU)}"/><a:ext cx="{round(w * EMU)}" cy="{round(h * EMU)}"/></{tag}>'


def _body(rows: list[tuple[int, str]]) -> str:
    return "".join(f'<a:p><a:pPr lvl="{level}"/><a:r><a:t>{escape(text)}</a:t></a:r></a:p>' for level, text in rows)


def text(rows: list[tuple[int, str]], y: float, role: str | None = None, box: bool = False, x: float = 20.0) -> str:
    """A shape with paragraphs (level, text): a placeholder of a role, a text box, or another shape."""
    mark = f"<p:nvPr><p:ph type={quoteattr(role)}/></p:nvPr>" if role else ""
    return f'<p:sp><p:nvSpPr><p:cNvSpPr{" txBox=%s" % quoteattr("1") if box else ""}/>{mark}</p:nvSpPr><p:spPr>{_frame(x, y, 300, 40)}</p:spPr><p:txBody>{_body(rows)}</p:txBody></p:sp>'


def table(rows: list[list[str]], y: float) -> str:
    cells = lambda row: "".join(f"<a:tc><a:txBody>{_body([(0, c)])}</a:txBody></a:tc>" for c in row)
    return f"<p:graphicFrame>{_frame(20, y, 300, 80, 'p:xfrm')}<a:graphic><a:graphicData><a:tbl>{''.join(f'<a:tr>{cells(r)}</a:tr>' for r in rows)}</a:tbl></a:graphicData></a:graphic></p:graphicFrame>"


def chart(link: str, y: float) -> str:
    return f'<p:graphicFrame>{_frame(20, y, 300, 80, "p:xfrm")}<a:graphic><a:graphicData><c:chart xmlns:c="{C}" r:id="{link}"/></a:graphicData></a:graphic></p:graphicFrame>'


def picture(link: str, y: float, w: float = 300.0, h: float = 200.0) -> str:
    return f'<p:pic><p:blipFill><a:blip r:embed="{link}"/></p:blipFill><p:spPr>{_frame(20, y, w, h)}</p:spPr></p:pic>'


def group(shapes: list[str], y: float) -> str:
    return f"<p:grpSp><p:grpSpPr>{_frame(20, y, 300, 100)}</p:grpSpPr>{''.join(shapes)}</p:grpSp>"


def connector(y: float) -> str:
    return f"<p:cxnSp><p:spPr>{_frame(20, y, 50, 1)}</p:spPr></p:cxnSp>"


def chart_part(categories: list[str], series: list[tuple[str, list[float]]]) -> str:
    points = lambda values: "".join(f'<c:pt idx="{i}"><c:v>{escape(str(v))}</c:v></c:pt>' for i, v in enumerate(values))
    one = lambda name, values: f"<c:ser><c:tx><c:strRef>{points([name])}</c:strRef></c:tx><c:cat>{points(categories)}</c:cat><c:val>{points(values)}</c:val></c:ser>"
    return f'<c:chartSpace xmlns:c="{C}">{"".join(one(*s) for s in series)}</c:chartSpace>'


def deck(slides: list[dict]) -> bytes:
    """The bytes of a deck; a slide is {shapes, hidden, notes, links: {id: part name}, parts: {part name: xml}}."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, s in enumerate(slides, 1):
            links = dict(s.get("links", {}))
            if s.get("notes"):
                links["notes"] = f"ppt/notesSlides/notesSlide{n}.xml"
                z.writestr(links["notes"], f'<p:notes xmlns:a="{A}" xmlns:p="{P}"><p:cSld><p:spTree>{text([(0, t) for t in s["notes"]], 0, "body")}{text([(0, str(n))], 1, "sldNum")}</p:spTree></p:cSld></p:notes>')
            for part, xml in s.get("parts", {}).items():
                z.writestr(part, xml)
            show = ' show="0"' if s.get("hidden") else ""
            z.writestr(f"ppt/slides/slide{n}.xml", f'<p:sld xmlns:a="{A}" xmlns:p="{P}" xmlns:r="{R}"{show}><p:cSld><p:spTree>{"".join(s["shapes"])}</p:spTree></p:cSld></p:sld>')
            if links:
                z.writestr(f"ppt/slides/_rels/slide{n}.xml.rels", f'<Relationships xmlns="{LINKS}">{"".join(f"<Relationship Id={quoteattr(i)} Target={quoteattr("/" + t)}/>" for i, t in links.items())}</Relationships>')
    return out.getvalue()

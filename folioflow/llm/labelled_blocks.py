"""The small labelled table of the page classifier.

Templates of pages, each with one letter per block in page order: `k` to keep, `.` to leave out.
Every template is filled several times, so that in pages that say where their text is the number
of words tells nothing, while in bare pages it does: there, stray blocks are short or links, and
short blocks of the text stand between long ones.
"""

from __future__ import annotations

from itertools import cycle, islice

#: Words per paragraph: `{any}` takes any of them in turn, `{long}` and `{few}` from their own.
ANY = (1, 60, 3, 25, 9, 40, 2, 14, 6)
LONG = (18, 45, 12, 70, 30)
FEW = (1, 3, 2, 4)
FILLINGS = 6

_MENU = "<nav><ul><li><a href=/>{few}</a></li><li><a href=/n>{few}</a></li></ul></nav>"

TEMPLATES: tuple[tuple[str, str], ...] = (
    (
        "<html><head><title>{any}</title></head><body>" + _MENU + "<div class=ad>{any}</div>"
        "<article><h1>{any}</h1><p>{any}</p><p>{any}</p><p>{any}</p><p>{any}</p></article><footer>{any}</footer></body></html>",
        "..." "kkkkk" ".",
    ),
    (
        "<body><header><h1>{few}</h1><p>{any}</p></header><main><h2>{any}</h2><p>{any}</p><ul><li>{any}</li><li>{any}</li></ul><p>{any} <a href=/x>{few}</a> {any}</p></main>"
        "<aside><h3>{few}</h3><p>{any}</p><p>{any}</p><ul><li><a href=/1>{any}</a></li></ul></aside><form><label>{few}</label><p>{any}</p></form></body>",
        ".." "kkkkk" "...." "..",
    ),
    (
        "<body><div id=menu><a href=/>{few}</a> <a href=/a>{few}</a></div><div class='cookie-notice'><p>{any}</p></div><article><h1>{any}</h1><p>{any}</p><p>{any} <a href=/b>{few}</a>.</p><p><a href=/c>{any}</a></p></article>"
        "<section id=comments><h3>{few}</h3><p>{any}</p><p>{any}</p></section><div class='footer'>{any}</div></body>",
        ".." "kkkk" "..." ".",
    ),
    (
        "<body>" + _MENU + "<article><header><h1>{any}</h1></header><p>{any}</p><aside><p>{any}</p><p>{few}</p></aside><p>{any}</p><div class='ad'>{any}</div><p>{any}</p><div class='share'>{few}</div>"
        "<div class=comments><p>{any}</p><p>{any}</p></div><form><p>{any}</p></form></article></body>",
        ".." "kk" ".." "k" "." "k" "." ".." ".",
    ),
    (
        "<body><p>{any}</p><article><p>{any}</p><p>{any}</p></article><div><p>{any}</p><p>{long}</p><p>{any}</p></div><p>{long}</p><p>{any}</p></body>",
        "." "kk" "..." "..",
    ),
    (
        "<body><p><a href=/>{few}</a> <a href=/n>{few}</a></p><p>{few}</p><p>{long}</p><p>{long}</p><p>{few}</p><p>{long}</p><p>{long} <a href=/y>{few}</a></p><p>{long}</p>"
        "<p><a href=/1>{any}</a></p><p><a href=/2>{long}</a></p><p><a href=/3>{long}</a> {few}</p><p>{few}</p><p>{few}</p></body>",
        ".." "kkkkkk" ".....",
    ),
    (
        "<body><div><a href=/>{few}</a></div><div>{few}</div><div><p>{long}</p><p>{long}</p><p>{few}</p><p>{long}</p></div><div><a href=/p>{long}</a> <a href=/t>{few}</a></div><div>{few}</div></body>",
        ".." "kkkk" "..",
    ),
    (
        "<body><div class='sidebar'><p>{any}</p></div><div class='story'><p>{any}</p><p>{any}</p><p>{any}</p></div><div class='newsletter'>{any}</div><div class='related'><a href=/q>{any}</a></div></body>",
        "." "kkk" "..",
    ),
    (
        "<body><div class='banner'>{any}</div><p>{long}</p><p>{long}</p><p>{long}</p><div class='promo'><p>{any}</p><p>{long}</p></div><footer><p>{any}</p></footer></body>",
        "." "kkk" ".." ".",
    ),
    (
        "<body><p>{few}</p><p>{long}</p><p>{long}</p><p>{few}</p><p>{long}</p><p>{long}</p></body>",
        "." "kkkkk",
    ),
)


def labelled_pages() -> list[tuple[str, str]]:
    """Every template with every filling."""
    pages = []
    for filling in range(FILLINGS):
        sizes = {
            name: islice(cycle(sizes), filling, None)
            for name, sizes in (("{any}", ANY), ("{long}", LONG), ("{few}", FEW))
        }
        for template, letters in TEMPLATES:
            page = template
            for name, numbers in sizes.items():
                while name in page:
                    page = page.replace(name, " ".join(["word"] * next(numbers)), 1)
            pages.append((page, letters))
    return pages

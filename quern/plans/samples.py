"""Small literal inputs of queries and of their SQL."""

PATHS = (
    "mail/a.txt", "mail/.DS_Store", "mail/._a.txt", "__MACOSX/a.txt", "x/__MACOSX/y/b.pdf", "scan/A.PDF", "scan/b.tar.gz", "img/c.JPeG", "img/d.webp",
    "office/e.docx", "office/f.eml", "noext", ".hidden", "dir.txt/g", "h.html", "i.md", "j.rtf", "k.xyz", "two words.csv", "m..json",
)
#: Patterns of phrases to drop: for lines (they begin with ^) and for whole texts.
PHRASES = ("^_{2,}$", "^page \\d+ of \\d+$", "confidential(?:ity)? notice", "\\bunsubscribe\\b", "__(?:date|time|year)__")
SHEET_TYPES = {"c0000": "chat_notes", "c0001": "email_notes", "noise": "web_notes"}

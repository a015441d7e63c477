"""Whether a link is that of a picture worth fetching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an image link must not come from or contain, and what it must end in.
IMAGE_ENDS = (".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp", ".tiff", ".avif", ".jfif")
OTHER_ENDS = (".html", ".htm", ".php", ".asp", ".aspx", ".jsp", ".js", ".css", ".json", ".xml", ".svg", ".ico", ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".mp4", ".mp3", ".avi", ".mov", ".wmv", ".flv")
BLOCKED_HOSTS = (
    "google.com", "google.co.id", "google.co.uk", "encrypted-tbn0.gstatic.com", "encrypted-tbn1.gstatic.com", "encrypted-tbn2.gstatic.com",
    "encrypted-tbn3.gstatic.com", "ssl.gstatic.com", "fonts.gstatic.com", "googleusercontent.com", "googleadservices.com",
    "pagead2.googlesyndication.com", "tpc.googlesyndication.com", "analytics.google.com", "doubleclick.net", "googlesyndication.com",
    "facebook.com", "fbcdn.net", "instagram.com", "schema.org", "ogp.me", "opengraph.io", "fonts.googleapis.com", "ajax.googleapis.com",
    "cdn.jsdelivr.net", "cdnjs.cloudflare.com",
)
BLOCKED_PARTS = ("/pagead/", "/aclk", "/intl/", "/policies/", "/preferences", "/maps/", "/translate", "/accounts/", "/blogs/read/", "/read/", "/artikel/", "/news/", "/berita/", "/product/", "/shop/", "/category/", "/tag/", "/author/", "/page/", "/post/", "/2023/", "/2024/", "/2025/")


def _ends(words: tuple[str, ...]) -> str:
    return "(" + "|".join(w.replace(".", r"\.") for w in words) + ")$"


def is_image_url(url: Column, strip_characters: bool = False) -> Column:
    """``strip_characters``: strip any of ``w.`` from the host's start instead of the prefix ``www.``."""
    host = F.lower(F.regexp_extract(url, r"^[a-z]+://([^/?#]*)", 1))
    host = F.regexp_replace(host, r"^[w.]+", "") if strip_characters else F.regexp_replace(host, r"^www\.", "")
    path = F.lower(F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1))
    query = F.lower(F.regexp_extract(url, r"\?([^#]*)", 1))
    blocked_host = host.rlike(r"(^|\.)(" + "|".join(h.replace(".", r"\.") for h in BLOCKED_HOSTS) + ")$")
    blocked_part = path.rlike("|".join(p.replace(".", r"\.") for p in BLOCKED_PARTS))
    asks = query.rlike(r"format=(jpg|jpeg|png|webp|gif|avif)") | query.rlike(r"\.(jpg|jpeg|png|webp|gif|avif)(\b|&|$)")
    return (
        F.when(url.isNull() | ~url.startswith("http"), False).when(blocked_host, False).when((path == "") | (path == "/"), False)
        .when(blocked_part, False).when(path.rlike(_ends(OTHER_ENDS)), False).when(path.rlike(_ends(IMAGE_ENDS)), True).otherwise(asks)
    )

"""Label lists and code tables."""

from __future__ import annotations

NOT_DETECTED = "Tidak terdeteksi"
#: As records minted from crawled pictures write it.
NOT_DETECTED_MINTED = "Tidak Terdeteksi"
# The labels of the three components, in code order.
ATAP = ("Beton", "Genteng", "Seng", "Asbes", "Bambu", "Kayu/sirap", "Jerami/ijuk/daun-daunan/rumbia", "Lainnya")
DINDING = ("Tembok", "Plesteran anyaman bambu/kawat", "Kayu/papan/gypsum/GRC/calciboard", "Anyaman bambu", "Batang kayu", "Bambu", "Lainnya")
LANTAI = ("Marmer/granit", "Keramik", "Parket/vinil/karpet", "Ubin/tegel/teraso", "Kayu/papan", "Semen/bata merah", "Bambu", "Tanah", "Lainnya")
LABELS = {"atap": ATAP, "dinding": DINDING, "lantai": LANTAI}
COMPONENTS = tuple(LABELS)
#: Components that pictures of one kind can show.
SHOWN = {"multi": COMPONENTS, "single_exterior_only": ("atap", "dinding"), "single_interior_only": ("lantai",)}


# Labels by survey code, as the survey writes them; not simply the labels above in lower case.
CODES = {
    "atap": {"1": "beton", "2": "genteng", "3": "seng", "4": "asbes", "5": "bambu", "6": "kayu/sirap", "7": "jerami/ijuk/daun-daunan/rumbia", "8": "lainnya"},
    "dinding": {"1": "tembok", "2": "plesteran_anyaman_bambu/kawat", "3": "kayu/papan/gypsum/GRC/calciboard", "4": "anyaman_bambu", "5": "batang_kayu", "6": "bambu", "7": "lainnya"},
    "lantai": {"1": "marmer/granit", "2": "keramik", "3": "parket/vinil/karpet", "4": "ubin/tegel/teraso", "5": "kayu/papan", "6": "semen/bata_merah", "7": "bambu", "8": "tanah", "9": "lainnya"},
}
# Further writings of labels, in the form in which labels are compared.
ALIASES = {
    "atap": {"kayu sirap": "Kayu/sirap", "jerami/ijuk/daun daunan/rumbia": "Jerami/ijuk/daun-daunan/rumbia"},
    "dinding": {"kayu papan gypsum grc calciboard": "Kayu/papan/gypsum/GRC/calciboard"},
    "lantai": {},
}


def code_table(component: str) -> dict[str, str]:
    """Survey code to label."""
    return CODES[component]


def label_map(component: str) -> dict[str, str]:
    """Compared form of every writing to the label that is written out."""
    return {x.lower(): x for x in (*LABELS[component], NOT_DETECTED)} | ALIASES[component]


#: Labels among which a synthetic reference is drawn.
ROOF_DRAW = tuple(x.lower() for x in ATAP)

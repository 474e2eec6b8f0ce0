"""Ordered signature rules of licences, written for words in lower case with one space between them.

A rule is (label, confidence, keyword, pattern). It is tried only on texts that hold the keyword. Rules that come
first win over later ones whose finding lies within theirs, so tags and titles with a version stand before
titles without, and those before weak hints. Families with versions are built from their titles.
"""

from __future__ import annotations

TAG, VERSIONED, TITLE, HINT = 1.0, 0.95, 0.8, 0.4
# The base phrases with their labels.
BASE = (
    ("gpl", "gnu", "gnu general public license"),
    ("apache", "apache", "apache license"),
    ("cc-by", "cc", "cc by"),
    ("mit", "mit", "mit license"),
)
_V = "(?: version| v| ver)?"
_LATER = " (?:or (?:at your option )?(?:any )?later(?: version)?|and later|plus)"
_LICENSE = " licen[cs]e"

# Fixed values: (label, keyword, title, versions) of families; a version is written 2.0 for the words "2 0" or "2".
FAMILIES = (
    ("gpl", "gpl", "(?:gnu )?gpl", "1.0 2.0 3.0"),
    ("gpl", "gnu", "gnu general public licen[cs]e", "1.0 2.0 3.0"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "2.0 2.1 3.0"),
    ("lgpl", "gnu", "gnu (?:lesser|library) general public licen[cs]e", "2.0 2.1 3.0"),
    ("agpl", "agpl", "(?:gnu )?agpl", "1.0 3.0"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e", "1.0 3.0"),
    ("gfdl", "gnu", "gnu free documentation licen[cs]e", "1.1 1.2 1.3"),
    ("apache", "apache", "apache(?: software)?(?: licen[cs]e)?", "1.0 1.1 2.0"),
    ("mpl", "mozilla", "mozilla public licen[cs]e", "1.0 1.1 2.0"),
    ("mpl", "mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", "eclipse public licen[cs]e", "1.0 2.0"),
    ("cddl", "cddl", "cddl", "1.0 1.1"),
    ("cddl", "development", "common development and distribution licen[cs]e", "1.0 1.1"),
    ("cpl", "common", "common public licen[cs]e", "0.5 1.0"),
    ("eupl", "eupl", "eupl", "1.0 1.1 1.2"),
    ("eupl", "european", "european union public licen[cs]e", "1.0 1.1 1.2"),
    ("osl", "open", "open software licen[cs]e", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", "academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", "artistic licen[cs]e", "1.0 2.0"),
    ("bsl", "boost", "boost software licen[cs]e", "1.0"),
    ("cecill", "cecill", "cecill", "1.0 1.1 2.0 2.1"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", "1.0"),
    ("zpl", "zope", "zope public licen[cs]e", "1.1 2.0 2.1"),
    ("lppl", "latex", "latex project public licen[cs]e", "1.0 1.1 1.2 1.3"),
    ("ofl", "font", "(?:sil )?open font licen[cs]e", "1.0 1.1"),
    ("upl", "universal", "universal permissive licen[cs]e", "1.0"),
    ("ecl", "educational", "educational community licen[cs]e", "1.0 2.0"),
    ("odbl", "database", "open (?:data commons open )?database licen[cs]e", "1.0"),
    ("rpl", "reciprocal", "reciprocal public licen[cs]e", "1.1 1.5"),
    ("psf", "python", "python software foundation licen[cs]e", "2.0"),
    ("sspl", "server", "server side public licen[cs]e", "1.0"),
    ("busl", "business", "business source licen[cs]e", "1.0 1.1"),
    ("elastic", "elastic", "elastic licen[cs]e", "1.0 2.0"),
    ("polyform", "polyform", "polyform (?:noncommercial|strict|shield|small business) licen[cs]e", "1.0"),
    ("mulan-psl", "mulan", "mulan (?:psl|permissive software licen[cs]e)", "1.0 2.0"),
    ("etalab", "etalab", "(?:licence ouverte )?etalab", "1.0 2.0"),
    ("ogl-uk", "government", "open government licen[cs]e", "1.0 2.0 3.0"),
    ("dl-de-by", "deutschland", "datenlizenz deutschland namensnennung", "1.0 2.0"),
)
# Creative Commons kinds in their short and long form, longest first.
CC_KINDS = (
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:s|atives)"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:s|atives)"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by", "by", "attribution"),
)
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

# SPDX identifiers that a tag may name.
SPDX = (
    "0bsd aal afl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 blueoak-1.0.0 "
    "bsd-2-clause bsd-3-clause bsd-4-clause bsl-1.0 cc-by-3.0 cc-by-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc-by-nc-4.0 cc0-1.0 "
    "cddl-1.0 cddl-1.1 cpl-1.0 ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.3-only gpl-1.0-only gpl-2.0-only "
    "gpl-2.0-or-later gpl-2.0 gpl-3.0-only gpl-3.0-or-later gpl-3.0 isc lgpl-2.1-only lgpl-2.1-or-later lgpl-2.1 "
    "lgpl-3.0-only lgpl-3.0-or-later lgpl-3.0 mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa ofl-1.1 osl-3.0 "
    "postgresql python-2.0 ruby sspl-1.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1"
).split()

# Titles and sentences without versions, then hints.
TITLES = (
    ("gpl", "gnu", "gnu gpl"),
    ("gpl", "general", "general public licen[cs]e"),
    ("gpl", "redistribute", "redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl", "library", "(?:gnu )?library general public licen[cs]e"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e"),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[cs]e"),
    ("apache", "apache", "(?:under|by) the apache licen[cs]e"),
    ("apache", "apache", "licensed to the apache software foundation"),
    ("mit", "mit", "(?:the )?mit x11 licen[cs]e"),
    ("mit", "mit", "(?:under|by) the mit licen[cs]e"),
    ("mit", "expat", "expat licen[cs]e"),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit-0", "mit", "mit no attribution"),
    ("isc", "isc", "isc licen[cs]e"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd-2-clause", "bsd", "(?:2|two) clause bsd(?: licen[cs]e)?|simplified bsd(?: licen[cs]e)?|freebsd licen[cs]e|bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:3|three) clause bsd(?: licen[cs]e)?|(?:new|revised|modified) bsd(?: licen[cs]e)?|bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:4|four) clause bsd(?: licen[cs]e)?|original bsd licen[cs]e|bsd 4 clause"),
    ("0bsd", "bsd", "zero clause bsd(?: licen[cs]e)?|bsd zero clause|0bsd"),
    ("bsd", "bsd", "bsd licen[cs]e|bsd style licen[cs]e"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla", "mozilla public licen[cs]e"),
    ("epl", "eclipse", "eclipse public licen[cs]e"),
    ("eupl", "european", "european union public licen[cs]e"),
    ("cddl", "development", "common development and distribution licen[cs]e"),
    ("cpl", "common", "common public licen[cs]e"),
    ("osl", "open", "open software licen[cs]e"),
    ("afl", "academic", "academic free licen[cs]e"),
    ("artistic", "artistic", "(?:perl )?artistic licen[cs]e"),
    ("bsl", "boost", "boost software licen[cs]e"),
    ("cecill", "cecill", "cecill [bc]|cecill"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e"),
    ("ofl", "font", "(?:sil )?open font licen[cs]e"),
    ("odbl", "database", "open database licen[cs]e"),
    ("odc-by", "commons", "open data commons attribution licen[cs]e"),
    ("pddl", "dedication", "public domain dedication and licen[cs]e"),
    ("psf", "psf", "psf licen[cs]e"),
    ("psf", "python", "python software foundation licen[cs]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng", "libpng licen[cs]e"),
    ("openssl", "openssl", "openssl licen[cs]e"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source licen[cs]e"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("php", "php", "php licen[cs]e"),
    ("ruby", "ruby", "ruby licen[cs]e"),
    ("vim", "vim", "vim licen[cs]e"),
    ("w3c", "w3c", "w3c (?:software notice and )?licen[cs]e"),
    ("unicode", "unicode", "unicode (?:licen[cs]e agreement|terms of use)"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "fuck", "do what the fuck you want to public licen[cs]e"),
    ("beerware", "beer", "beer ?ware licen[cs]e"),
    ("sspl", "server", "server side public licen[cs]e"),
    ("busl", "business", "business source licen[cs]e"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "commons", "creative commons zero(?: 1 0)?"),
    ("cc-pdm", "commons", "creative commons public domain mark"),
    ("cc", "commons", "creative commons(?: licen[cs]e)?"),
    ("cc-by", "cc", "(?:licensed|released) under cc by"),
    ("ogl", "gaming", "open gaming licen[cs]e"),
    ("ogl-uk", "government", "open government licen[cs]e"),
    ("commercial", "commercial", "commercial licen[cs]e(?: agreement)?"),
    ("proprietary", "proprietary", "proprietary (?:and confidential|licen[cs]e|software)"),
    ("eula", "user", "end user licen[cs]e agreement"),
)
HINTS = (
    ("public-domain", "public", "(?:in|into) the public domain|public domain"),
    ("all-rights-reserved", "rights", "all rights reserved"),
    ("all-rights-reserved", "droits", "tous droits réservés"),
    ("all-rights-reserved", "rechte", "alle rechte vorbehalten"),
    ("all-rights-reserved", "derechos", "todos los derechos reservados"),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("copyright", "copyrighted", "copyrighted material"),
    ("no-commercial-use", "commercial", "(?:for )?non ?commercial use only|not for commercial use"),
    ("no-redistribution", "redistribution", "redistribution (?:is )?(?:not permitted|prohibited)"),
    ("copyleft", "copyleft", "copyleft"),
)


def _number(version: str) -> str:
    major, minor = version.split(".")
    return f" {major}(?: 0)?(?! [0-9])" if minor == "0" else f" {major} {minor}"


def rules() -> list[tuple[str, float, str, str]]:
    """(label, confidence, keyword, pattern) in order; a pattern starts at a space and ends before one."""
    found = [(i, TAG, "spdx", f"spdx licen[cs]e identifier {_words(i)}") for i in sorted(SPDX, key=len, reverse=True)]
    for label, keyword, title, versions in FAMILIES:
        for version in versions.split():
            name = f"{title}{_V}{_number(version)}"
            found.append((f"{label}-{version}-or-later", VERSIONED, keyword, name + _LATER))
            found.append((f"{label}-{version}", VERSIONED, keyword, name + f"(?:{_LICENSE})?"))
    for label, short, long in CC_KINDS:
        for version in CC_VERSIONS.split():
            tail = f"(?: international| unported| generic)?{_V}{_number(version)}(?: international| unported| generic)?(?:{_LICENSE})?"
            found.append((f"{label}-{version}", VERSIONED, "cc", f"cc {short}{tail}"))
            found.append((f"{label}-{version}", VERSIONED, "commons", f"creative commons {long}{tail}"))
    for label, short, long in CC_KINDS:
        found.append((label, TITLE, "cc", f"cc {short}"))
        found.append((label, TITLE, "commons", f"creative commons {long}(?:{_LICENSE})?"))
    found += [(label, TITLE, keyword, pattern) for label, keyword, pattern in TITLES]
    found += [(label, HINT, keyword, pattern) for label, keyword, pattern in HINTS]
    return [(label, c, k, f" (?:{p})(?= )") for label, c, k, p in found]


def _words(identifier: str) -> str:
    return identifier.replace("-", " ").replace(".", " ")

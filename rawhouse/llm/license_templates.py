"""Licence templates in template markup.

``<<beginOptional>>...<<endOptional>>`` may be missing (and may nest);
``<<var;name=...;original=...;match=...>>`` stands for other words: ``.+`` one or
more, ``.*`` any number, ``.{a,b}`` a to b words.  All other wording is mandatory.
"""

# Phrases every scan reports: label -> wording.
PHRASES = {
    "mit": "under the MIT license",
    "apache-2": "Apache License Version 2",
    "cc-by-nc": "CC BY NC",
}

# The wording of public licences and licence notices.
_MIT_BODY = """
Permission is hereby granted, free of charge, to any person obtaining a copy of
<<var;name="what";original="this software and associated documentation files";match=".{1,12}">>
(the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice
<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL
<<var;name="holder";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".{1,12}">>
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE
"""
_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:
<<var;name="bullet";original="1.";match=".{0,1}">> Redistributions of source code
must retain the above copyright notice, this list of conditions and the following
disclaimer. <<var;name="bullet";original="2.";match=".{0,1}">> Redistributions in
binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with
the distribution.
"""
_BSD_THIRD = """
<<var;name="bullet";original="3.";match=".{0,1}">> Neither the name of
<<var;name="holder";original="the copyright holder";match=".{1,12}">> nor the names
of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY
<<var;name="holder";original="THE COPYRIGHT HOLDERS AND CONTRIBUTORS";match=".{1,12}">>
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES
"""

# Templates that add labels of their own: (label, markup).
TEMPLATES = (
    ("mit", _MIT_BODY),
    ("bsd-2-clause", _BSD_HEAD + _BSD_TAIL),
    ("bsd-3-clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright
        notice and this permission notice appear in all copies""",
    ),
    (
        "apache-2",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the
        License at""",
    ),
    (
        "gpl-3",
        """licensed under <<beginOptional>>the terms of <<endOptional>><<beginOptional>>the
        <<endOptional>>GNU General Public License <<beginOptional>>as published by the Free
        Software Foundation <<endOptional>><<beginOptional>>either <<endOptional>>version 3""",
    ),
    (
        "gpl-3",
        """you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation,
        <<beginOptional>>either <<endOptional>>version 3""",
    ),
    (
        "lgpl-3",
        """under <<beginOptional>>the terms of <<endOptional>>the GNU Lesser General Public
        License <<beginOptional>>as published by the Free Software Foundation
        <<endOptional>><<beginOptional>>either <<endOptional>>version 3""",
    ),
    (
        "mpl-2",
        """This Source Code Form is subject to the terms of the Mozilla Public License,
        v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one
        at""",
    ),
    (
        "cc-by-nc-4",
        """licensed under <<beginOptional>>a <<endOptional>><<beginOptional>>Creative
        Commons <<endOptional>>CC BY-NC 4.0""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is
        free to copy, modify, publish, use, compile, sell, or distribute this software""",
    ),
)

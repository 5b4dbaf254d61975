"""Licence templates: phrases, and the notices that projects copy into their files."""

from __future__ import annotations

from dataclasses import dataclass

# Public licence notices, as their authors word them.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons": "cc",
    "cc by": "cc",
    "cc by nc": "cc-nc",
    "cc by sa": "cc-sa",
}
MIT_NOTICE = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software.
"""
ISC_NOTICE = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
"""
BSD_NOTICE = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.
"""
APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.
"""
GPL_NOTICE = """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details.
"""
MPL_NOTICE = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
NOTICES = {
    "mit": MIT_NOTICE,
    "isc": ISC_NOTICE,
    "bsd": BSD_NOTICE,
    "apache": APACHE_NOTICE,
    "gpl": GPL_NOTICE,
    "mpl": MPL_NOTICE,
}
# Phrases whose places are counted.
BASE_PHRASES = ("mit license", "apache license", "general public license")


@dataclass(frozen=True)
class Template:
    """Words to find: ``k`` words a gram, the least share of its grams, and how far diagonals may lie apart."""

    label: str
    text: str
    k: int
    least: float
    slack: int
    base: bool = False


# Words of a gram, share of a notice's grams and words put in or left out that a notice may bear.
NOTICE_WORDS = 5
NOTICE_SHARE = 0.5
NOTICE_SLACK = 5


def templates() -> list[Template]:
    """Phrases must stand whole, word by word; notices may be changed in places."""
    phrases = [Template(label, text, 2, 1.0, 0, text in BASE_PHRASES) for text, label in PHRASES.items()]
    notices = [Template(label, text, NOTICE_WORDS, NOTICE_SHARE, NOTICE_SLACK) for label, text in NOTICES.items()]
    return phrases + notices

"""Licence texts as passages, each with the phrase that must stand in it.

Short licences are given whole, long ones by the notice that their authors ask to be
put into files.
"""

# Public licence texts. Label, the label that takes its place where both
# are found, and passages with their mandatory phrases.
TEXTS = [
    (
        "mit",
        None,
        [
            (
                "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                'and associated documentation files (the "Software"), to deal in the Software without '
                "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                "Software is furnished to do so, subject to the following conditions:",
                "to deal in the software without restriction",
            ),
            (
                "The above copyright notice and this permission notice shall be included in all copies or "
                "substantial portions of the Software.",
                "this permission notice shall be included in all copies",
            ),
            (
                'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
                "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
                "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
                "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
                "the software is provided as is",
            ),
        ],
    ),
    (
        "bsd-2-clause",
        "bsd-3-clause",
        [
            (
                "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met:",
                "redistribution and use in source and binary forms",
            ),
            (
                "Redistributions of source code must retain the above copyright notice, this list of conditions "
                "and the following disclaimer.",
                "redistributions of source code must retain",
            ),
            (
                "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                "and the following disclaimer in the documentation and/or other materials provided with the "
                "distribution.",
                "redistributions in binary form must reproduce",
            ),
        ],
    ),
    (
        "bsd-3-clause",
        None,
        [
            (
                "Redistributions of source code must retain the above copyright notice, this list of conditions "
                "and the following disclaimer.",
                "redistributions of source code must retain",
            ),
            (
                "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                "and the following disclaimer in the documentation and/or other materials provided with the "
                "distribution.",
                "redistributions in binary form must reproduce",
            ),
            (
                "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                "or promote products derived from this software without specific prior written permission.",
                "may be used to endorse or promote products derived from this software",
            ),
        ],
    ),
    (
        "isc",
        None,
        [
            (
                "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                "in all copies.",
                "this software for any purpose with or without fee is hereby granted",
            ),
            (
                'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
                "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
                "the author disclaims all warranties with regard to this software",
            ),
        ],
    ),
    (
        "zlib",
        None,
        [
            (
                "Permission is granted to anyone to use this software for any purpose, including commercial "
                "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
                "to alter it and redistribute it freely",
            ),
            (
                "The origin of this software must not be misrepresented; you must not claim that you wrote the "
                "original software.",
                "the origin of this software must not be misrepresented",
            ),
            (
                "This notice may not be removed or altered from any source distribution.",
                "may not be removed or altered from any source distribution",
            ),
        ],
    ),
    (
        "unlicense",
        None,
        [
            (
                "This is free and unencumbered software released into the public domain.",
                "free and unencumbered software released into the public domain",
            ),
            (
                "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either "
                "in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
                "by any means.",
                "for any purpose commercial or non commercial and by any means",
            ),
        ],
    ),
    (
        "apache-2.0",
        None,
        [
            (
                'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except '
                "in compliance with the License. You may obtain a copy of the License at",
                "you may not use this file except in compliance with the license",
            ),
            (
                "Unless required by applicable law or agreed to in writing, software distributed under the License "
                'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express '
                "or implied. See the License for the specific language governing permissions and limitations under "
                "the License.",
                "unless required by applicable law or agreed to in writing",
            ),
        ],
    ),
    (
        "gpl-2.0-or-later",
        None,
        [
            (
                "This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version.",
                "gnu general public license as published by the free software foundation either version 2 of",
            ),
            (
                "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
                "General Public License for more details.",
                "see the gnu general public license for more details",
            ),
        ],
    ),
    (
        "gpl-3.0-or-later",
        None,
        [
            (
                "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version.",
                "gnu general public license as published by the free software foundation either version 3",
            ),
            (
                "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
                "General Public License for more details.",
                "see the gnu general public license for more details",
            ),
        ],
    ),
    (
        "agpl-3.0-or-later",
        None,
        [
            (
                "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
                "of the License, or (at your option) any later version.",
                "gnu affero general public license as published by the free software foundation",
            ),
        ],
    ),
    (
        "lgpl-2.1-or-later",
        None,
        [
            (
                "This library is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU Lesser General Public License as published by the Free Software Foundation; either version "
                "2.1 of the License, or (at your option) any later version.",
                "gnu lesser general public license as published by the free software foundation either version 2 1",
            ),
        ],
    ),
    (
        "mpl-2.0",
        None,
        [
            (
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at",
                "subject to the terms of the mozilla public license v 2 0",
            ),
        ],
    ),
]

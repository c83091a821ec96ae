"""Known licences: (id, kind, text). Public licence texts and one-line notices."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

ZERO_BSD = ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")

BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

"""
BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

"""
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

KNOWN = [
    ("MIT", "text", MIT), ("MIT", "text", "MIT License\n\n" + MIT), ("MIT", "text", "The MIT License (MIT)\n\n" + MIT),
    ("MIT", "text", "The MIT License\n\n" + MIT), ("ISC", "text", "The ISC License\n\n" + ISC),
    ("ISC", "text", ISC), ("ISC", "text", "ISC License\n\n" + ISC),
    ("0BSD", "text", ZERO_BSD), ("0BSD", "text", "BSD Zero Clause License\n\n" + ZERO_BSD),
    ("BSD-2-Clause", "text", BSD_HEAD + BSD_TAIL), ("BSD-2-Clause", "text", "BSD 2-Clause License\n\n" + BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", "text", BSD_HEAD + BSD_NAME + BSD_TAIL),
    ("BSD-3-Clause", "text", "BSD 3-Clause License\n\n" + BSD_HEAD + BSD_NAME + BSD_TAIL),
    ("Zlib", "text", ZLIB), ("Zlib", "text", "zlib License\n\n" + ZLIB),
    ("Unlicense", "text", UNLICENSE), ("Unlicense", "text", "The Unlicense\n\n" + UNLICENSE),
    ("MIT", "notice", "Released under the MIT License."), ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "This project is licensed under the MIT License."), ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "notice", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-3.0", "notice", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "notice", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "notice", "Released under CC0 1.0."),
    ("BSD-2-Clause", "notice", "SPDX-License-Identifier: BSD-2-Clause"), ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "notice", "SPDX-License-Identifier: MPL-2.0"), ("ISC", "notice", "SPDX-License-Identifier: ISC"),
]

#: Fixed values: (id, digest of the canonical form) of long licence texts as Linux distributions
#: ship them; tests/llm/test_licenses.py makes them again from such files where they are installed.
DIGESTS = [
    ("Apache-2.0", "74cc9759ce3a37250b40072a398f6d32"),
    ("Apache-2.0", "5e1b0859e77bf238019e09c2acd7b897"),
    ("CC0-1.0", "93a180096f6cfcf2c0dd24f75c2eec48"),
    ("GFDL-1.2", "8d64296097632a6da16bb912a89806d5"),
    ("GFDL-1.3", "1912cb3b2f2c8f73108dbb863f8ea241"),
    ("GPL-1.0", "e513b86acaafe4ee44051c6200fad91b"),
    ("GPL-1.0", "90db245cacd09dd7f9bddc2bf92c4d4d"),
    ("GPL-2.0", "c6e44c05da0bd121e39e1a00e8571ce4"),
    ("GPL-2.0", "757dba826af7b629dff02d967b72ab8a"),
    ("GPL-3.0", "e4e09635b1d6f826dcf1e1ddb6682a27"),
    ("GPL-3.0", "6affd9584153e5f043862de9ddecba3a"),
    ("LGPL-2.0", "fd5c42bc693d3ad279cf7eb459c8d50b"),
    ("LGPL-2.0", "edf4d5584ce31ab1548eedc5dedc1d75"),
    ("LGPL-2.1", "3f554d01f627f29bdce11767a44fd410"),
    ("LGPL-2.1", "1d08da8cbd5642055d95d42626eae017"),
    ("LGPL-3.0", "148b473852f0e3b14ba500ebbd2e8f9c"),
    ("MPL-1.1", "b5ac6f16ce55a80f3713c3845156d332"),
    ("MPL-2.0", "3e00e008c04aa92b30ad6a7ab2a46921"),
]

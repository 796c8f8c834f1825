"""A reader of Java source: top-level types with their members and the calls in their bodies.

It works on tokens and knows comments, text blocks, annotations, generics and nesting; what it doesn't need (statements,
nested types, initialisers) it steps over.
"""

from __future__ import annotations

import re

_TOKEN = re.compile(r'//[^\n]*|/\*.*?\*/|"""(?:\\.|[^\\])*?"""|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|[^\W\d][\w$]*|\$[\w$]*|\d[\w.]*|\.\.\.|->|::|[^\s\w]', re.S)
_MODIFIERS = frozenset("public protected private static final abstract native synchronized transient volatile strictfp default sealed".split())
_NOT_CALLED = frozenset("if for while switch catch synchronized return throw new super this assert try do else instanceof".split())
_CLOSING = {"(": ")", "{": "}", "[": "]", "<": ">"}
KINDS = ("class", "interface", "enum")


class Reader:
    def __init__(self, source: str) -> None:
        self.source = source
        found = [m for m in _TOKEN.finditer(source) if not m[0].startswith(("//", "/*"))]
        self.tokens = [m[0] for m in found]
        self.spans = [m.span() for m in found]
        self.lines, line, at = [], 1, 0
        for a, _ in self.spans:
            line += source.count("\n", at, a)
            at = a
            self.lines.append(line)
        self.at = 0

    def peek(self, ahead: int = 0) -> str:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ""

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1] if self.at <= len(self.tokens) else ""

    def text(self, a: int, b: int) -> str:
        return self.source[self.spans[a][0] : self.spans[b - 1][1]] if a < b else ""

    def skip_group(self) -> None:
        """Step over a bracketed group that begins here."""
        opening = self.peek()
        closing, depth = _CLOSING[opening], 0
        while self.at < len(self.tokens):
            t = self.take()
            depth += (t == opening) - (t == closing)
            if not depth:
                return

    def skip_to(self, *ends: str) -> None:
        """Step to the first of the ends that stands outside brackets."""
        while self.at < len(self.tokens) and self.peek() not in ends:
            if self.peek() in ("(", "{", "["):
                self.skip_group()
            else:
                self.at += 1

    def name(self) -> str:
        parts = [self.take()]
        while self.peek() == "." and re.match(r"[^\W\d]|\$", self.peek(1)):
            self.at += 1
            parts.append(self.take())
        return ".".join(parts)

    def type_name(self) -> str:
        a = self.at
        while self.peek() == "@":
            self.annotation()
            a = self.at
        self.name()
        while self.peek() in ("<", "[", "."):
            if self.peek() == ".":
                self.at += 1
                self.name()
            else:
                self.skip_group()
        return re.sub(r"\s+", " ", self.text(a, self.at))

    def annotation(self) -> dict:
        line = self.lines[self.at]
        self.at += 1
        name, value = self.name(), None
        if self.peek() == "(":
            a = self.at
            self.skip_group()
            value = self.text(a + 1, self.at - 1)
        return {"name": name.rsplit(".", 1)[-1], "value": value or None, "line": line}

    def head(self) -> tuple[list[str], list[dict], int]:
        """Modifiers and annotations in front of a declaration, and its first line."""
        modifiers, annotations, line = [], [], self.lines[self.at] if self.at < len(self.lines) else 0
        while True:
            if self.peek() == "@" and self.peek(1) != "interface":
                annotations.append(self.annotation())
            elif self.peek() in _MODIFIERS and not (self.peek() == "default" and self.peek(1) in (":", "->")):
                modifiers.append(self.take())
            elif self.peek() == "non" and self.peek(1) == "-":
                self.at += 3
            else:
                return modifiers, annotations, line

    def parameters(self) -> list[dict]:
        out = []
        self.at += 1
        while self.at < len(self.tokens) and self.peek() != ")":
            modifiers, annotations, _ = self.head()
            kind = self.type_name()
            variadic = self.peek() == "..."
            self.at += variadic
            name = self.take()
            while self.peek() == "[":
                self.skip_group()
                kind += "[]"
            out.append({"name": name, "type": kind, "position": len(out), "variadic": variadic, "final": "final" in modifiers, "annotations": annotations})
            if self.peek() == ",":
                self.at += 1
        self.at += 1
        return out

    def calls(self, a: int, b: int) -> list[dict]:
        """Invocations and constructions between two tokens, in order."""
        out = []
        for k in range(a, b):
            t = self.tokens[k]
            if t == "new" and re.match(r"[^\W\d]", self.tokens[k + 1]):
                here, self.at = self.at, k + 1
                made = self.name()
                if self.peek() == "<":
                    self.skip_group()
                if self.peek() == "(":
                    out.append({"target_class": made, "target_method": "<init>", "line": self.lines[k], "constructor": True})
                self.at = here
            elif self.tokens[k + 1 : k + 2] == ["("] and re.match(r"[^\W\d]|\$", t) and t not in _NOT_CALLED:
                if self.constructed(k, a):
                    continue
                if k > a and self.tokens[k - 1] == ".":
                    out.append({"target_class": self.receiver(k - 2, a), "target_method": t, "line": self.lines[k], "constructor": False})
                else:
                    out.append({"target_class": None, "target_method": t, "line": self.lines[k], "constructor": False})
        return out

    def constructed(self, k: int, a: int) -> bool:
        while k - 2 >= a and self.tokens[k - 1] == ".":
            k -= 2
        return k > a and self.tokens[k - 1] == "new"

    def receiver(self, k: int, a: int) -> str:
        """The text in front of a dot: names, calls and indexes that hang together."""
        end = k + 1
        while k >= a:
            t = self.tokens[k]
            if t in (")", "]"):
                opening, depth = {")": "(", "]": "["}[t], 0
                while k >= a:
                    depth += (self.tokens[k] == t) - (self.tokens[k] == opening)
                    if not depth:
                        break
                    k -= 1
                if k - 1 >= a and re.match(r"[^\W\d]", self.tokens[k - 1]) and self.tokens[k - 1] not in _NOT_CALLED:
                    k -= 1
                    continue
            if k - 1 >= a and self.tokens[k - 1] == ".":
                k -= 2
                continue
            if k - 1 >= a and self.tokens[k - 1] == "new":
                k -= 1
            break
        return re.sub(r"\s+", "", self.text(max(k, a), end)) if self.tokens[max(k, a)] != "new" else re.sub(r"\s+", " ", self.text(k, end))

    def body(self) -> list[dict]:
        a = self.at
        self.skip_group()
        return self.calls(a + 1, self.at - 1)

    def members(self, owner: str, kind: str) -> dict:
        out = {"fields": [], "methods": [], "constructors": []}
        self.at += 1
        if kind == "enum":
            self.skip_to(";", "}")
        while self.at < len(self.tokens) and self.peek() != "}":
            if self.peek() == ";":
                self.at += 1
                continue
            modifiers, annotations, line = self.head()
            if self.peek() == "{":
                self.skip_group()
                continue
            if self.peek() in KINDS or self.peek() == "@" or self.peek() == "record" and self.peek(2) in ("(", "<"):
                self.skip_to("{")
                if self.peek() == "{":
                    self.skip_group()
                continue
            if self.peek() == "<":
                self.skip_group()
            shared = {"modifiers": modifiers, "annotations": annotations, "line": line}
            if self.peek() == owner and self.peek(1) == "(":
                self.at += 1
                given = self.parameters()
                self.skip_to("{", ";", "}")
                calls = self.body() if self.peek() == "{" else []
                out["constructors"].append(shared | {"name": owner, "parameters": given, "calls": calls, "end": self.lines[min(self.at, len(self.lines)) - 1]})
                continue
            before = self.at
            type_name = self.type_name()
            name = self.take()
            if self.peek() == "(":
                given = self.parameters()
                self.skip_to("{", ";", "}")
                has_body = self.peek() == "{"
                calls = self.body() if has_body else []
                self.at += not has_body and self.peek() == ";"
                out["methods"].append(shared | {"name": name, "type": type_name, "parameters": given, "calls": calls, "end": self.lines[min(self.at, len(self.lines)) - 1], "has_body": has_body})
            else:
                while self.at < len(self.tokens):
                    own = type_name
                    while self.peek() == "[":
                        self.skip_group()
                        own += "[]"
                    out["fields"].append(shared | {"name": name, "type": own})
                    self.skip_to(",", ";", "}")
                    if self.peek() != ",":
                        break
                    self.at += 1
                    name = self.take()
            if self.at == before:
                self.at += 1
        self.at += 1
        return out

    def types_after(self, word: str) -> list[str]:
        out = []
        if self.peek() == word:
            self.at += 1
            out.append(self.type_name())
            while self.peek() == ",":
                self.at += 1
                out.append(self.type_name())
        return out

    def file(self) -> dict:
        out = {"package": "", "imports": [], "types": []}
        while self.at < len(self.tokens):
            modifiers, annotations, line = self.head()
            t = self.take()
            if t == "package":
                out["package"] = self.name()
            elif t == "import":
                static = self.peek() == "static"
                self.at += static
                name = self.name()
                wild = self.peek() == "." and self.peek(1) == "*"
                out["imports"].append({"name": name, "static": static, "wildcard": wild, "line": line})
            elif t in KINDS and re.match(r"[^\W\d]|\$", self.peek()):
                name = self.take()
                if self.peek() == "<":
                    self.skip_group()
                extended = self.types_after("extends")
                implemented = self.types_after("implements")
                self.types_after("permits")
                first = {"name": name, "kind": t, "modifiers": modifiers, "annotations": annotations, "line": line, "extends": extended, "implements": implemented}
                self.skip_to("{")
                held = self.members(name, t) if self.peek() == "{" else {"fields": [], "methods": [], "constructors": []}
                out["types"].append(first | held | {"end": self.lines[min(self.at, len(self.lines)) - 1]})
            elif t in ("@", "record"):
                self.skip_to("{", ";")
                if self.peek() == "{":
                    self.skip_group()
        return out


def read(source: str | None) -> dict:
    return Reader(source or "").file()

"""Lexical scan of client sources (JavaScript, TypeScript, JSX): where code is and how it nests.

Which brackets, calls and templates of a text are code depends on everything before them: strings, two kinds of
comments, regular expression literals, and templates whose ``${`` leads back into code, to any depth. No regular
expression can tell, so one pass per file keeps the open brackets and templates as a stack. What it finds are small
rows for the relational operators; names, options and operations are read from them by Spark expressions.

A row's ``head`` is the code before it in its statement, flattened: closed brackets are empty, comments are gone. So
``export const A: FC = memo(forwardRef(({ id }, ref) => {`` has the head ``export const A: FC = memo(forwardRef(() =>``.

A string ends at the end of its line, as an apostrophe of JSX text does. An arrow whose body is an expression ends with
that expression: at a comma, semicolon or closing bracket around it, or at a line break that cannot be inside one.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: The calls that are looked for.
HOOKS = ("useQuery", "useLazyQuery", "useMutation", "useSubscription")

CODE = re.compile(
    r"(?P<comment>//[^\n]*|/\*.*?(?:\*/|\Z))|(?P<string>'[^'\\\n]*(?:\\.[^'\\\n]*)*'?|\"[^\"\\\n]*(?:\\.[^\"\\\n]*)*\"?)"
    r"|(?P<name>(?<![\w$])(?:" + "|".join([*HOOKS, "gql"]) + r")(?![\w$]))|=>|[`{}()\[\];,/]", re.S)
TEMPLATE = re.compile(r"\\.|`|\$\{", re.S)
REGEX = re.compile(r"/(?:[^/\\\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/")
CALL = re.compile(r"(?:\s*<[^;()]*>)?\s*\(")
TAG = re.compile(r"(?:\s*<[^;()]*>)?\s*(?:\(\s*)?`")
WORD_BEFORE = re.compile(r"[\w$]+$")
#: Words after which a slash begins a regular expression, and after which a brace is no block.
BEFORE_REGEX = {"return", "typeof", "case", "in", "of", "delete", "void", "instanceof", "new", "do", "else", "yield", "await"}
NO_BLOCK = {"const", "let", "var", "import", "export", "return", "default", "case", "in", "of", "new", "typeof", "type"}
GOES_ON_AFTER, GOES_ON_BEFORE = "=>([{,.?:&|+-*/%<!~^", ".?:&|+*/%<>=,)]}"
MOST_HEAD = 1000
CLOSES = {")": "(", "]": "[", "}": "{"}


class Event(NamedTuple):
    """kind ``body`` (a block or arrow that may be a function's), ``hook`` or ``gql``; ``bodies``: places of the bodies
    around it, innermost first. text: first argument or template; options: second argument of a hook, flattened."""

    kind: str
    pos: int
    line: int
    name: str | None
    head: str
    text: str | None
    options: str | None
    bodies: list[int]


class Frame:
    """An open bracket, template (`) or interpolation ($): what its current statement or argument reads so far."""

    __slots__ = ("kind", "parts", "mark", "hook", "arguments", "options", "block", "tag", "start")

    def __init__(self, kind: str, mark: int):
        self.kind, self.mark, self.start = kind, mark, mark
        self.parts: list[str] = []
        self.hook = self.options = self.tag = None
        self.arguments: list[str] = []
        self.block = False

    def keep(self, text: str) -> None:
        self.parts.append(text)
        if len(self.parts) > 400 and self.hook is None:
            del self.parts[:-100]


def last_char(text: str, end: int, least: int = 0) -> tuple[str, int]:
    """The last character before ``end`` that is not white space, and its place."""
    end -= 1
    while end >= least and text[end].isspace():
        end -= 1
    return (text[end], end) if end >= least else ("", end)


class Scan:
    def __init__(self, text: str):
        self.text = text
        self.frames = [Frame("{", 0)]
        self.frames[0].block = True
        self.bodies: list[tuple[int, int, bool]] = []  # (frames open inside it at least, place, is an arrow's expression)
        self.events: list[Event] = []
        self.line, self.counted = 1, 0
        self.calls: dict[int, tuple] = {}
        self.tags: dict[int, tuple] = {}

    def line_at(self, pos: int) -> int:
        self.line += self.text.count("\n", self.counted, pos)
        self.counted = pos
        return self.line

    def head(self, pos: int) -> str:
        """The flattened code before ``pos``, from the innermost block on."""
        out: list[str] = []
        for i in range(len(self.frames) - 1, -1, -1):
            f = self.frames[i]
            out.append("".join(f.parts[-100:]) + (self.text[max(f.mark, pos - MOST_HEAD) : pos] if i == len(self.frames) - 1 else ""))
            if f.kind not in "([" or sum(map(len, out)) > MOST_HEAD:
                break
            out.append(f.kind)
        return "".join(reversed(out))[-MOST_HEAD:]

    def emit(self, kind, pos, line, name=None, head="", text=None, options=None, bodies=None):
        around = [p for _, p, _ in reversed(self.bodies)] if bodies is None else bodies
        self.events.append(Event(kind, pos, line, name, head, text, options, around))

    def leave_arrows(self, depth: int) -> None:
        """Expressions of arrows that began with ``depth`` frames open, or more, end."""
        while self.bodies and self.bodies[-1][2] and self.bodies[-1][0] >= depth:
            self.bodies.pop()

    def line_breaks(self, start: int, end: int) -> None:
        """An expression ends at a line break between tokens, unless it goes on."""
        if not (self.bodies and self.bodies[-1][2] and self.bodies[-1][0] == len(self.frames) and self.frames[-1].kind == "{"):
            return
        at = self.text.find("\n", start, end)
        while at >= 0:
            before, _ = last_char(self.text, at, self.bodies[-1][1])
            after = self.text[at:].lstrip()[:1] if end - at > 5000 else self.text[at : end + 1].strip()[:1]
            if before and before not in GOES_ON_AFTER and after not in GOES_ON_BEFORE:
                self.leave_arrows(len(self.frames))
                return
            at = self.text.find("\n", at + 1, end)

    def run(self) -> list[Event]:
        text, pos, size = self.text, 0, len(self.text)
        while pos < size:
            top = self.frames[-1]
            if top.kind == "`":
                m = TEMPLATE.search(text, pos)
                if not m:
                    break
                if m[0] == "${":
                    self.frames.append(Frame("$", m.end()))
                elif m[0] == "`":
                    self.close_template(m.start())
                pos = m.end()
                continue
            m = CODE.search(text, pos)
            if not m:
                self.line_breaks(pos, size)
                break
            at = m.start()
            if self.bodies:
                self.line_breaks(pos, at)
            pos = self.token(m, m[0], at, m.end())
        return self.events

    def token(self, m: re.Match, token: str, at: int, end: int) -> int:
        top, text = self.frames[-1], self.text
        first = m.lastgroup
        if first == "comment":
            if token[1] == "/" and at and text[at - 1] == ":" and text[at - 2 : at - 1].isalpha():
                return at + 2  # the slashes of an address in JSX text
            top.keep(text[top.mark : at] + " ")
            top.mark = end
        elif first == "name":
            if token == "gql":
                if tag := TAG.match(text, end):
                    self.tags[tag.end() - 1] = (at, self.line_at(at), self.head(at), [p for _, p, _ in reversed(self.bodies)])
            elif call := CALL.match(text, end):
                self.calls[call.end() - 1] = (token, at, self.line_at(at), self.head(at), [p for _, p, _ in reversed(self.bodies)])
        elif token == "/":
            before, place = last_char(text, at)
            word = WORD_BEFORE.search(text, max(0, place - 10), place + 1) if before.isalnum() else None
            if (before in "" or before in "(,=:[!&|?{;+-*%>~^" or word and word[0] in BEFORE_REGEX) and text[end : end + 1] != ">":
                if found := REGEX.match(text, at):
                    return found.end()
        elif token == "`":
            top.keep(text[top.mark : at])
            top.mark = at
            self.frames.append(Frame("`", end))
            self.frames[-1].tag = self.tags.pop(at, None)
        elif token == "=>":
            after = text[end:].lstrip()[:1] if end + 200 > len(text) else text[end : end + 200].lstrip()[:1]
            if after != "{":  # a block opens its own body
                self.emit("body", at, self.line_at(at), head=self.head(end))
                self.bodies.append((len(self.frames), at, True))
        elif token in "([{":
            self.opened(token, at, end)
        elif token in ")]}":
            self.closed(token, at, end)
        elif token == ",":
            self.leave_arrows(len(self.frames))
            if top.hook and top.kind == "(":
                top.arguments.append("".join(top.parts) + text[top.mark : at])
                top.parts, top.mark = [], end
        elif token == ";":
            self.leave_arrows(len(self.frames))
            top.parts, top.mark = [], end
        return end

    def opened(self, token: str, at: int, end: int) -> None:
        top, text = self.frames[-1], self.text
        frame = Frame(token, end)
        frame.hook = self.calls.pop(at, None) if token == "(" else None
        if token == "{":
            if top.hook and top.kind == "(" and len(top.arguments) == 1:
                frame.hook = top.hook  # its options object
            head = self.head(at).rstrip()
            word = WORD_BEFORE.search(head)
            frame.block = head[-1:] in ("", ")", ";", "{", "}", ">") or bool(word and word[0] not in NO_BLOCK)
            if head.endswith((")", "=>")) or ")" in head and head.rfind(")") > max(head.rfind("="), head.rfind(";")) and ":" in head[head.rfind(")") :]:
                self.emit("body", at, self.line_at(at), head=head)
                self.bodies.append((len(self.frames) + 1, at, False))
        top.keep(text[top.mark : at])
        top.mark = at
        self.frames.append(frame)

    def closed(self, token: str, at: int, end: int) -> None:
        kind = CLOSES[token]
        if token == "}" and self.frames[-1].kind == "$":
            self.leave_arrows(len(self.frames))
            self.frames.pop()  # back in the template
            return
        if self.frames[-1].kind != kind or len(self.frames) == 1:
            # a bracket that does not fit closes the innermost one that does, if it is in this interpolation
            place = len(self.frames) - 1
            while place > 0 and self.frames[place].kind != kind and self.frames[place].kind not in "$`":
                place -= 1
            if place == 0 or self.frames[place].kind != kind or kind != "{":
                return
            del self.frames[place + 1 :]
        frame = self.frames.pop()
        while self.bodies and self.bodies[-1][0] > len(self.frames):
            self.bodies.pop()
        top, flat = self.frames[-1], "".join(frame.parts) + self.text[frame.mark : at]
        if frame.hook and frame.kind == "(":
            name, pos, line, head, bodies = frame.hook
            frame.arguments.append(flat)
            self.emit("hook", pos, line, name, head, frame.arguments[0], frame.options, bodies)
        elif frame.hook and top.hook is frame.hook:
            top.options = flat
        top.keep(kind + token)
        top.mark = end
        if frame.block and top.kind == "{" and top.block:
            self.leave_arrows(len(self.frames))
            top.parts = []

    def close_template(self, at: int) -> None:
        frame = self.frames.pop()
        if frame.tag:
            pos, line, head, bodies = frame.tag
            self.emit("gql", pos, line, None, head, self.text[frame.start : at], None, bodies)
        top = self.frames[-1]
        top.keep("``")
        top.mark = at + 1


def scan(text: str) -> list[Event]:
    return Scan(text).run()

"""Syntax the lexer reads, values it takes for credentials, and time that grows with the text."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import secret_scan
from tideline.llm.assignments import lex_assignments

KEY = "q7Zp0vX2LmN8rT4w"


def literals(text):
    return [text[s:e] for k, s, e in secret_scan.find_secrets(text) if k == "literal"]


@pytest.mark.parametrize("text", [
    f'var passwd_db string = "{KEY}"', f'var dbPwd string = "{KEY}"', f'String dbPwd = "{KEY}";',
    f'os.environ["DB_PWD"] = "{KEY}"', f"config['db']['pwd'] = '{KEY}'", f"<dbPwd>{KEY}</dbPwd>",
    f"<dbPwd type='x'> {KEY} </dbPwd>", f'<add key="Db.Pwd" value="{KEY}"/>', f"<property value='{KEY}' name='pwd'>",
    f'setPwd("{KEY}")', f'props.setProperty("db.pwd", "{KEY}")', f"define('DB_PWD', '{KEY}');",
    f'pwd = """{KEY}"""', f"pwd = '''\n  {KEY}\n'''", f"pwd: |\n  {KEY}\nnext: 1", f"pwd: >-\n\n    {KEY}",
    f'db_pwd <- "{KEY}"', f'user, pwd = "me", "{KEY}"', f'pwd, user = "{KEY}", "me"', f'pwd, user := "{KEY}", "me"',
    f'key1 = "{KEY}"\npwd = f"{{key1}}"', f'key1 = "{KEY}"\npwd = "${{key1}}"', f'k = "{KEY}"\npwd = "#{{k}}"',
    f'k = "{KEY}"\nconnect(pwd=f"{{k!r}}")', f'pwd: str = "{KEY}"', f'pwd: Optional = "{KEY}"', f'pwd = rb"{KEY}"',
    f'pwd = b64decode("{KEY}")', f'pwd = os.getenv("x", "{KEY}")', f'pwd = (\n  "{KEY}"\n)', f"mysql --db-pwd={KEY}",
    f'{"x" * 300}_pwd = "{KEY}"', f'if pwd == "{KEY}":', f'"pwd" : "{KEY}"', f"`pwd` => `{KEY}`", f'pwd ||= "{KEY}"',
    f'connect(host="h", pwd="{KEY}", port="1")', f'pwd ?= {KEY}', f"pwd = @\"{KEY}\"",
])
def test_syntax(text):
    assert literals(text) == [KEY]


def test_parts_around_a_reference_and_side_by_side():
    assert literals(f'k = "{KEY}"\npwd = f"{KEY[:8]}{{k}}{KEY[8:]}"') == [KEY, KEY[:8], KEY[8:]]
    assert literals(f'pwd = ("{KEY[:8]}"\n   "{KEY[8:]}")') == [KEY[:8], KEY[8:]]
    assert literals(f"pwd: |\n  {KEY[:9]}\n\n  {KEY[9:]}\nother: {KEY}") == [KEY[:9], KEY[9:]]


@pytest.mark.parametrize("text", [
    'pwd = "correct horse battery staple"', 'pwd = "Tr0ub4dor3x9"', 'pwd = "hunTer!xyzzy"', 'passphrase: "violet anchor drumming sixteenth"',
])
def test_credentials_of_words(text):
    assert len(literals(text)) == 1


@pytest.mark.parametrize("text", [
    'pwd = "please enter your new password"', 'pwd = "the password is wrong here"', 'pwd = "open sesame 1 2"', "pwd: see the notes",
    'pwd = "username"', 'pwd = "placeholder"', f'title = "{KEY}"', f'pwd != "{KEY}"', f'a, b = "{KEY}", pwd', 'pwd = "short1"',
    f"<name>{KEY}</name> pwd", "passphrase::lookup", f'getTitle("{KEY}") + pwd', 'pwd = ""', 'pwd = """', "pwd = (", "pwd: |", "pwd =",
    'pwd = f"{', "<pwd", 'pwd = "${', "= pwd", ", = pwd", '"] = pwd',
])
def test_no_credential(text):
    assert literals(text) == []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="pwd=:<>\"'`(),.[]{}$#|\n \t-f1aZ/\\+&?!", max_size=60))
def test_any_text_is_read(text):
    pairs, references = lex_assignments(text)
    for pair in pairs:
        assert pair.name and all(0 <= s <= e <= len(text) for s, e in pair.spans)
    assert all(a and b for a, b in references)
    for kind, s, e in secret_scan.find_secrets("pwd " + text):
        assert kind in secret_scan.KINDS and s < e


@pytest.mark.parametrize("unit", [
    "a-", "a.", "a,", "a=", "a:", "pwd(", 'pwd("x", ', "<pwd ", "<pwd>", '"', "'''", "pwd = (", "pwd: |\n ", "x + ", "f(", "${a}",
    "var a b ", '"a" ', "a b=", "[\"a\"]", "pwd=a+", "(\"", "pwd = \"\"\"a", "= ",
])
def test_time_grows_with_the_text(unit):
    def seconds(n):
        text = "pwd " + unit * n
        best = float("inf")
        for _ in range(3):
            start = time.process_time()
            secret_scan.literal_spans(text)
            best = min(best, time.process_time() - start)
        return best

    small = seconds(4000)
    assert seconds(16000) <= 8 * small + 0.05

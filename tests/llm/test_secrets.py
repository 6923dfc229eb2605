"""The lexer's syntax, and a planted corpus: what is found, and what is not."""

import random
import string
import time

import pytest

from tripmill.llm import queries as L
from tripmill.llm import secret_scan
from tripmill.llm.source_lexer import Pairs, tokens_of

S = "hunter2Zq9"


def named(text):
    return [(text[a:b], name) for kind, a, b, name, _ in secret_scan.secret_spans(text) if kind == "named"]


@pytest.mark.parametrize("text, found", [
    (f'os.environ["DB_PWD"] = "{S}"', [(S, "DB_PWD")]),
    (f"config['client_pwd'] = '{S}'", [(S, "client_pwd")]),
    (f"define('DB_PWD', '{S}');", [(S, "DB_PWD")]),
    (f'{{"db_pwd":\n   "{S}"}}', [(S, "db_pwd")]),
    (f'db_pwd = \\\n    "{S}"', [(S, "db_pwd")]),
    ('db_pwd = (\n    "hunter2"\n    "Zq9"\n)', [("hunter2", "db_pwd"), ("Zq9", "db_pwd")]),
    ('db_pwd = ("hunter2" + "Zq9")', [("hunter2", "db_pwd"), ("Zq9", "db_pwd")]),
    (f"  db_pwd: |\n    {S}\n  other: x", [(S, "db_pwd")]),
    (f"db_pwd: >-\n  {S}\nnext: 1", [(S, "db_pwd")]),
    (f'db_pwd = """{S}"""', [(S, "db_pwd")]),
    (f"db_pwd = '''\n{S}\n'''", [(S, "db_pwd")]),
    (f"<db_pwd>{S}</db_pwd>", [(S, "db_pwd")]),
    (f"<a><db_pwd> {S} </db_pwd><b>x</b></a>", [(S, "db_pwd")]),
    (f'{{"name":"DB_PWD","value":"{S}"}}', [(S, "DB_PWD")]),
    (f"- name: DB_PWD\n  value: {S}", [(S, "DB_PWD")]),
    (f'conf.setPassphrase("{S}")', [(S, "Passphrase")]),
    (f"tool --passphrase {S} --verbose", [(S, "passphrase")]),
    (f'tool --db-pwd="{S}"', [(S, "db-pwd")]),
    (f"DB_PWD ?= {S}", [(S, "DB_PWD")]),
    (f'db_pwd ||= "{S}"', [(S, "db_pwd")]),
    (f'db_pwd += "{S}"', [(S, "db_pwd")]),
    (f'db_pwd?: string = "{S}"', [(S, "db_pwd")]),
    (f'const dbPwd: string | undefined = "{S}"', [(S, "dbPwd")]),
    ('db_pwd = f"hunter2{n}Zq9"', [("hunter2", "db_pwd"), ("Zq9", "db_pwd")]),
    ('part = "Qx7"\ndb_pwd = `hunter2${part}`', [("hunter2", "db_pwd"), ("Qx7", "db_pwd")]),
    ('db_pwd = "hunter2 Zq9"', [("hunter2 Zq9", "db_pwd")]),
    (f'db_pwd = x\nx = "{S}"', [(S, "db_pwd")]),
    (f'if a:\n    x = "{S}"\nelse:\n    x = "other7Kw2"\ndb_pwd = x', [(S, "db_pwd"), ("other7Kw2", "db_pwd")]),
    (f'db_pwd = "{S}" if prod else "other7Kw2"', [(S, "db_pwd"), ("other7Kw2", "db_pwd")]),
    (f'db_pwd = os.getenv("X", "{S}")', [(S, "db_pwd")]),
    (f'db_pwd = os.environ.get("X") or "{S}"', [(S, "db_pwd")]),
    (f'db_pwd = get("X", default="{S}")', [(S, "db_pwd")]),
    (f'db_pwd = SecretStr("{S}")', [(S, "db_pwd")]),
    (f'conn = "Server=db;Pwd={S};Timeout=3"', [(S, "Pwd")]),
    (f'"db_pwd" => "{S}",', [(S, "db_pwd")]),
    (f"db_pwd := `{S}`", [(S, "db_pwd")]),
    (f"setenv('DB_PWD', '{S}')", [(S, "DB_PWD")]),
    (f"# db_pwd: {S}", [(S, "db_pwd")]),
    # Not literals, or not secret.
    ('db_pwd = os.getenv("DB_PWD_NAME1")', []),
    ("db_pwd = settings.database.passphrase", []),
    ("db_pwd = get_passphrase()", []),
    ("db_pwd = user_input", []),
    ("db_pwd = None", []),
    ('db_pwd = "Enter the passphrase here"', []),
    ('print("db_pwd", x)', []),
    ("it's a pwd: isn't it? don't say", []),
    ("db_pwd:\n  nested1a: hunter2\n", []),
    ('title = "x" if db_pwd else "hunter2Zq9"', []),
    ("a <db_pwd> b </other> hunter2Zq9", []),
    ("db_pwd == hunter2Zq9", []),
    ("db_pwd::hunter2Zq9", []),
    ("def login(pwd: str, token: str = None): pass", []),
    ('{"name":"title","value":"hunter2Zq9"}', []),
    ('{"pwd":\n "a": "hunter2Zq9"}', []),
])
def test_syntax(text, found):
    assert sorted(named(text)) == sorted(found)


def test_tokens_cover_the_text_in_order():
    chance = random.Random(4)
    for _ in range(300):
        text = "".join(chance.choices("ab =:\"'`\\\n(){}<>|+f-.", k=chance.randint(0, 80)))
        at = 0
        for token in tokens_of(text):
            assert token.start >= at and token.end > token.start
            at = token.end
        for names, value in Pairs(text):
            assert all(names)
            for part in (p for parts in value for p in parts):
                assert 0 <= part[0] <= part[1] <= len(text)


FORMS = [
    '{n} = "{v}"', "{n}: {v}", '"{n}": "{v}",', "export {n}='{v}'", "{n} := `{v}`", 'set_{n}("{v}")', "--{n} {v}", "<{n}>{v}</{n}>",
    'os.environ["{n}"] = "{v}"', "define('{n}', '{v}')", '{n}: str = "{v}"', 'x{i} = "{v}"\n{n} = x{i}', '{n} = x{i}\nx{i} = "{v}"',
    "{n}: |\n  {v}", '{n} = (\n  "{v}"\n)', '{n} = getenv("A", "{v}")', '{{"name": "{n}", "value": "{v}"}}', '{n} ||= "{v}"',
]
SENSITIVE = ["db_pwd", "client_passphrase", "PrivateKey", "AWS_CREDENTIAL", "signingKey", "Passcode", "bearer_auth"]
PLAIN = ["title", "path", "page_count", "color", "username", "pwd_length", "token_type", "key_name", "comment", "version"]


def planted(chance, count):
    """Lines of code and prose with secrets at known places, and others that look alike."""
    lines, secrets, others = [], [], []
    for i in range(count):
        value = "".join(chance.choices(string.ascii_letters + string.digits, k=chance.randint(10, 24))) + chance.choice("0123456789")
        form = chance.choice(FORMS)
        kind = chance.random()
        if kind < 0.4:
            lines.append(form.format(n=chance.choice(SENSITIVE), v=value, i=i))
            secrets.append(value)
        elif kind < 0.8:
            lines.append(form.format(n=chance.choice(PLAIN), v=value, i=i))
            others.append(value)
        else:
            lines.append(chance.choice([
                "The quick brown fox: it isn't here.", "if (a == b) { return c; }", "for i in range(10): pass", "a, b = b, a",
                "db_pwd = settings.database.pwd", 'db_pwd = os.getenv("DB_PWD")', "pwd = input('Your passphrase? ')", 'token = "changeme"',
            ]))
    return "\n".join(lines) + "\n", secrets, others


def test_planted_corpus():
    """Precision and recall over 60 files of some 100 lines; README gives the figures."""
    chance = random.Random(2024)
    right = wrong = missed = 0
    for _ in range(60):
        text, secrets, others = planted(chance, 100)
        spans = secret_scan.secret_spans(text)
        found = {text[a:b] for _, a, b, *_ in spans}
        covered = {s for s in secrets if any(s in f or f in s for f in found)}
        right += len(covered)
        missed += len(secrets) - len(covered)
        # What the fixed patterns find is right by definition.
        lexed = {text[a:b] for kind, a, b, *_ in spans if kind == "named"}
        wrong += sum(not any(s in f or f in s for s in secrets) for f in lexed)
    recall, precision = right / (right + missed), right / (right + wrong)
    print(f"recall {recall:.4f}, precision {precision:.4f}, {right + missed} secrets")
    assert recall > 0.99 and precision > 0.99


def test_secrets_planted_in_documents(spark, sf_dir):
    """The registered query's operator over the documents with a planted line each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("doc_id < 120").collect()
    chance = random.Random(8)
    rows, places = [], {}
    for row in docs:
        text, secrets, _ = planted(chance, 4)
        rows.append((row["doc_id"], f"{row['text'] or ''}\n{text}{row['text'] or ''}"))
        places[row["doc_id"]] = secrets
    found = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    missed = 0
    for row in found:
        spans = [texts[row["doc_id"]][s["start"] : s["end"]] for s in row["spans"]]
        missed += sum(not any(secret in s or s in secret for s in spans) for secret in places[row["doc_id"]])
    assert missed <= 0.01 * sum(map(len, places.values()))


@pytest.mark.parametrize("text", [
    "pwd = (" * 40_000, "pwd = f(" * 40_000, 'pwd = "a" + ' * 40_000, "pwd: |\n" * 30_000, "<pwd>" * 60_000, "pwd = x if " * 30_000,
    "'pwd\\'" * 40_000, '"""' * 50_001, "pwd='''" * 30_001, "`pwd" * 50_001, '"pwd\\"' * 40_000, "--pwd " * 60_000, "pwd[" * 60_000,
    'pwd["a"]' * 40_000, "pwd:\n" * 50_000, "pwd: x<" * 40_000, "{" * 100_000 + "pwd", "f(\"pwd\"," * 40_000, "pwd = x or " * 40_000,
    "".join(f"pwd{i} = x{i}\nx{i} = x{i + 1}\n" for i in range(15_000)), "x = pwd\n" * 40_000 + "pwd = x\n" * 40_000,
])
def test_odd_code_takes_linear_time(text):
    begun = time.process_time()
    secret_scan.secret_spans(text)
    assert time.process_time() - begun < 20


def test_every_row_has_its_spans(spark, sf_dir):
    rows = L.op1_secret_scan(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()

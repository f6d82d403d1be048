from assaywright.llm import secrets


def test_one_case_secrets_with_names_and_prefixes(docs_of):
    value, other = "q7zt0xw9lbv3mkd8rfyp2hsj", "4ec39hqlyjwdarjtt1zdp7dc9x"
    said = [f"sig={value}", f"sk_live_{other}", f"a/b-{value}", f"SIG={value.upper()}", "ID_0A1B2C3D4E5F60718293A4B5", f"{value[:12]}_{value[12:]}", value]
    clean = ["id=550e8400-e29b-41d4-a716-446655440000", "top-10-ways-to-fix-your-old-home", "thisisaverylongwordwithoutanything1", "no=12345678901234567890123"]
    df = docs_of(*enumerate(f"see {x} end" for x in said + clean))
    found = {r["doc_id"]: r["spans"] for r in secrets.report(df).collect()}
    for i, x in enumerate(said):
        kind, start, end = found[i].split(":")
        assert kind == "entropy" and int(start) < 4 + len(x) - 20 + 1 and int(end) >= 4 + len(x) - 2, x
    assert [found[i] for i in range(len(said), len(said + clean))] == [""] * len(clean)

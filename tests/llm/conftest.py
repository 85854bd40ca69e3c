import pytest


@pytest.fixture(autouse=True)
def _prepared(request):
    if "spark" in request.fixturenames:
        from ledgerflow.llm.common import prepare
        prepare(request.getfixturevalue("spark"))

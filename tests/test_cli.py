from conftest import SF_SMALL


def test_cli_list_and_run(spark, capsys):
    from tillroll.__main__ import main
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.split("\n")
    assert "top10_products" in listed and any(x.startswith("rfm_segment ") for x in listed)
    assert main(["run", "m_total_skus", SF_SMALL, "--rows", "1"]) == 0
    assert "total_skus" in capsys.readouterr().out
    assert main(["run", "no_such_query", SF_SMALL]) == 2

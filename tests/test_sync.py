import datetime as dt
import json

from fieldfit.plans.sync import apply_payload
from fieldfit.schemas import SNAPSHOTS
from fieldfit.sources import SnapshotStore

FIRST = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
SECOND = dt.datetime(2024, 5, 2, tzinfo=dt.timezone.utc)


def test_two_synchronisations(spark, tmp_path, frame, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    members = [("a@x", "A", "smb", "colaborador", True, None), ("b@x", "B", "icp", "colaborador", True, 2)]
    store.publish(spark.createDataFrame(members, SNAPSHOTS["team_members"]), "team_members")

    def sync(name, bundle, as_of, **chunks):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "latest.json").write_text(json.dumps(bundle))
        for table, files in chunks.items():
            for i, content in enumerate(files):
                (folder / f"{table}-{i:02d}.json").write_text(json.dumps(content))
        return apply_payload(spark, store, str(folder / "latest.json"), str(folder), as_of)

    done = sync(
        "one",
        {
            "tickets": [{"ticket_id": str(i), "company_id": "c", "esn_list": ["1"]} for i in range(60)],
            "ticket_products": [{"ticket_id": "1", "product_label": "R", "quantity": 2}],
            "team_members_updates": [{"email": "a@x", "hubspot_owner_id": 7}, {"email": "zz@x", "hubspot_owner_id": 9}],
        },
        FIRST,
        ticket_deal_ids=[[{"ticket_id": "1", "deal_id": "d1"}, {"ticket_id": "999", "deal_id": "d9"}]],
        completude_instalacao=[[{"deal_id": "d1", "nota_instalacao": 1}], [{"deal_id": "d1", "nota_instalacao": 4}]],
    )
    assert set(done) == {"tickets_sync", "ticket_products", "team_members", "completude_instalacao_snapshot"}
    assert rows(store.current("completude_instalacao_snapshot"), "deal_id", "nota_instalacao") == [("d1", 4)]
    assert rows(store.current("team_members"), "email", "hubspot_owner_id") == [("a@x", 7), ("b@x", 2)]
    tickets = store.current("tickets_sync")
    assert tickets.count() == 60 and rows(tickets.filter("deal_id is not null"), "ticket_id", "deal_id") == [("1", "d1")]

    # A partial payload updates but removes nothing, and keeps filled-in deals.
    sync("two", {"tickets": [{"ticket_id": "1", "company_id": "new"}]}, SECOND)
    tickets = store.current("tickets_sync")
    assert tickets.count() == 60
    assert rows(tickets.filter("ticket_id = '1'"), "company_id", "deal_id", "esn_list") == [("new", "d1", ["1"])]
    assert tickets.select("synced_at").distinct().count() == 1

    # A full one removes what left it; new rows are stamped with their own time.
    full = [{"ticket_id": str(i)} for i in range(10, 70)]
    sync("three", {"ticket_products": [{"ticket_id": "1", "product_label": "S", "quantity": 1}]}, SECOND, tickets=[full[:30], full[30:]])
    tickets = store.current("tickets_sync")
    assert tickets.count() == 60 and tickets.filter("ticket_id = '1'").isEmpty()
    assert tickets.select("synced_at").distinct().count() == 2
    assert rows(store.current("ticket_products")) == [("1", "S", 1)]

    # A field that no schema knows becomes a column, in tickets as in other tables.
    sync("four", {"completude_instalacao": [{"deal_id": "d2", "obra": 3}], "tickets": [{"ticket_id": "10", "obra": "x"}], "ticket_products": [{"ticket_id": "2", "obra": 1}]}, SECOND)
    assert rows(store.current("completude_instalacao_snapshot"), "deal_id", "nota_instalacao", "obra") == [("d1", 4, None), ("d2", None, 3)]
    assert rows(store.current("tickets_sync").filter("obra is not null"), "ticket_id", "obra") == [("10", "x")]
    assert rows(store.current("ticket_products"), "ticket_id", "product_label", "obra") == [("1", "S", None), ("2", None, 1)]
    assert store.current("tickets_sync").count() == 60
    # and stays when later payloads lack it
    sync("five", {"completude_instalacao": [{"deal_id": "d2", "nota_instalacao": 1}, {"deal_id": "d3"}]}, SECOND)
    assert rows(store.current("completude_instalacao_snapshot"), "deal_id", "nota_instalacao", "obra") == [("d1", 4, None), ("d2", 1, 3), ("d3", None, None)]

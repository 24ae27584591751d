"""A small seeded bank that lands its files date by date, with planted faults and a truth file."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

from . import writers

FIRST = ["Asha", "Ravi", "Meena", "Vikram", "Anita", "Suresh", "Kavita", "Rahul", "Divya", "Arjun", "Lakshmi", "Nikhil"]
LAST = ["Sharma", "Iyer", "Patel", "Reddy", "Nair", "Gupta", "Das", "Menon", "Rao", "Kulkarni", "Bose", "Joshi"]
CITIES = [("Pune", "MH", "WEST", "411001"), ("Chennai", "TN", "SOUTH", "600001"), ("Delhi", "DL", "NORTH", "110001"), ("Kolkata", "WB", "EAST", "700001")]
DATES = ["2026-09-21", "2026-09-22", "2026-09-23", "2026-09-24", "2026-09-25"]
BANK = "NORB"


class Bank:
    """Everything is drawn in one order from one seed, so a date's files don't depend on which dates are asked for."""

    def __init__(self, customers: int = 60, seed: int = 7):
        r = self.r = random.Random(seed)
        self.people, self.customers, self.accounts, self.loans = [], [], [], []
        self.truth: dict = {"persons": [], "aml": [], "faults": {}}
        for p in range(customers):
            city, state, region, pin = r.choice(CITIES)
            born = date(1955, 1, 1) + timedelta(days=r.randrange(16_000))
            pan = "".join(r.choices("ABCDEFGHJK", k=5)) + f"{p:04d}" + r.choice("PQRS")
            self.people.append({"pid": p, "first": r.choice(FIRST), "last": r.choice(LAST), "dob": born, "pan": pan, "mobile": f"9{r.randrange(10**9):09d}", "city": city, "state": state, "pin": pin, "line": f"{r.randrange(1, 99)} MG Rd."})
            self.truth["persons"].append({"pid": p, "cbs": [], "lms": [], "crm": []})
        day = "2026-09-20 10:00:00"
        for p in self.people:
            for copy in range(2 if p["pid"] % 15 == 3 else 1):
                cid = 100_000 + len(self.customers)
                first = p["first"] if not copy else p["first"] + p["first"][-1]
                self.customers.append([cid, r.choice(["MR", "MS"]), first, None, p["last"], str(p["dob"]), r.choice("MF"), p["pan"], f"{r.randrange(10**12):012d}", p["mobile"], f"{p['first'].lower()}{p['pid']}@mail.example.com", p["line"], None, p["city"], p["state"], p["pin"], r.choice(["VERIFIED", "PENDING"]), r.choice(["MASS", "AFFLUENT", "PRIVATE"]), "BR001", day, day])
                self.truth["persons"][p["pid"]]["cbs"].append(cid)
                for _ in range(r.choice([1, 1, 2])):
                    self.accounts.append([f"{10**13 + len(self.accounts)}", cid, None, r.choice(["SA01", "CA01", "TD01"]), r.choice(["BR001", "BR002"]), "INR", "2020-01-15", "ACTIVE", None, Decimal("3.50"), day])
            if p["pid"] % 3 == 0:
                lid = f"LB{len(self.truth['persons'][p['pid']]['lms']) + p['pid']:06d}"
                self.truth["persons"][p["pid"]]["lms"].append(lid)
                self.loans.append({"id": f"LN{p['pid']:08d}", "borrower": lid, "person": p, "product": r.choice(["HL01", "PL01"]), "principal": Decimal(r.randrange(100_000, 900_000)), "dpd": r.choice([0, 0, 10, 45, 88, 200, 600])})
            if p["pid"] % 4 == 1:
                self.truth["persons"][p["pid"]]["crm"].append(f"CRM-{p['pid']:08x}")
        self.customers[1][4] = None  # no last name
        self.customers[2][5] = "1985-02-30"
        self.truth["faults"][DATES[0]] = {"cbs_customer": 2}
        # cash just under the threshold on three dates, a day's credits sent on, a listed customer
        self.truth["aml"] = [
            {"rule": "AML-STR-01", "subject": f"ACC:CBS:{self.accounts[0][0]}", "complete_on": DATES[3]},
            {"rule": "AML-PTH-01", "subject": f"ACC:CBS:{self.accounts[1][0]}", "complete_on": DATES[4]},
            {"rule": "AML-WL-01", "subject": "WL000001", "complete_on": DATES[0]},
        ]
        self.balances = {a[0]: Decimal(r.randrange(1_000, 200_000)) for a in self.accounts}

    def _cdc(self, op: str, at: int, pos: int, before: dict | None, after: dict | None) -> dict:
        return {"op": op, "ts_ms": at, "source": {"connector": "mysql", "db": "cbs", "table": "customer", "file": "bin.000001", "pos": pos}, "before": before, "after": after}

    def _row(self, i: int, **changes) -> dict:
        names = ["cust_id", "title", "first_name", "middle_name", "last_name", "dob", "gender", "pan", "aadhaar", "mobile", "email", "addr_line1", "addr_line2", "city", "state", "pincode", "kyc_status", "segment", "home_branch", "created_at", "updated_at"]
        return dict(zip(names, self.customers[i], strict=True)) | changes

    def land(self, landing: Path, day: str) -> None:
        n, tag = DATES.index(day), day.replace("-", "")
        at = int(datetime.fromisoformat(day + "T06:00:00").replace(tzinfo=timezone.utc).timestamp() * 1000)
        for source in ("cbs", "lms", "payments", "crm", "documents", "compliance"):
            (landing / source / day).mkdir(parents=True, exist_ok=True)
        cbs, entities = landing / "cbs" / day, []
        if n == 0:
            from .contracts import CONTRACTS

            names = {e: [c["name"] for c in CONTRACTS[e]["columns"]] for e in ("cbs_branch", "cbs_product", "cbs_customer", "cbs_account")}
            tables = {
                "branch": (names["cbs_branch"], [(f"BR{i:03d}", f"{BANK}0{i:06d}", f"Branch {i}", *CITIES[i % 4][:2], CITIES[i % 4][2], "2001-04-01") for i in (1, 2)]),
                "product": (names["cbs_product"], [("SA01", "Savings", "SA", "DEPOSITS", 3), ("CA01", "Current", "CA", "DEPOSITS", 0), ("TD01", "Term", "TD", "DEPOSITS", 7), ("HL01", "Home loan", "HL", "LENDING", 8), ("PL01", "Personal loan", "PL", "LENDING", 12)]),
                "customer": (names["cbs_customer"], [tuple(c) for c in self.customers]),
                "account": (names["cbs_account"], [tuple(a) for a in self.accounts]),
            }
            writers.write_dump(cbs / f"cbs_dump_{tag}.sql", tables)
            entities += [{"entity": f"cbs_{t}", "records": len(rows)} for t, (_, rows) in tables.items()]
        else:
            events = [self._cdc("u", at, 100 * n, self._row(4), self._row(4, segment=["MASS", "AFFLUENT", "PRIVATE"][n % 3], updated_at=f"{day} 11:30:00"))]
            if n == 1:
                events.append(self._cdc("u", at + 5, 110, None, self._row(1, last_name="Corrected", updated_at=f"{day} 11:31:00")))
            if n == 2:  # the later event stands first
                events = [self._cdc("u", at + 9_000, 220, None, self._row(5, mobile="9111111111")), self._cdc("u", at + 1_000, 210, None, self._row(5, mobile="9222222222")), *events]
            if n == 3:
                events += [self._cdc("d", at + 10, 330, self._row(6), None), self._cdc("d", at + 11, 340, {"cust_id": 999_999}, None)]
            if n == 4:
                events.append(events[0])
            writers.write_jsonl(cbs / f"cbs_cdc_{tag}.jsonl", events)
            entities.append({"entity": "cbs_cdc_event", "records": len(events)})
        rows = []
        for a in self.accounts:
            self.balances[a[0]] += self.r.randrange(-500, 900)
            rows.append((a[0], day, self.balances[a[0]], self.balances[a[0]], "INR"))
        if n == 1:
            rows[0] = (rows[0][0], day, "N/A", rows[0][3], "INR")
        if n == 3:
            rows.append(rows[3])
        total = sum((Decimal(x[2]) for x in rows if x[2] != "N/A"), Decimal(0))
        writers.write_psv(cbs / f"cbs_eod_balance_{tag}.csv", ["acct_no", "bal_date", "ledger_balance", "available_balance", "currency"], rows, total)
        entities.append({"entity": "cbs_eod_balance", "records": len(rows), "control_field": "ledger_balance", "control_total": str(total)})
        writers.write_manifest(cbs, "cbs", day, entities)
        self._lms(landing / "lms" / day, day, n, tag)
        self._payments(landing / "payments" / day, day, n, tag)
        self._others(landing, day, n, tag)
        (landing / "_truth").mkdir(exist_ok=True)
        (landing / "_truth" / "persons.json").write_text(json.dumps(self.truth))

    def _lms(self, folder: Path, day: str, n: int, tag: str) -> None:
        shown = lambda d: d.strftime("%d/%m/%Y")
        d = date.fromisoformat(day)
        people = [(x["borrower"], f"{x['person']['first']} {x['person']['last']}", shown(x["person"]["dob"]), x["person"]["pan"].lower(), x["person"]["mobile"], x["person"]["line"], x["person"]["city"], x["person"]["pin"], self.truth["persons"][x["person"]["pid"]]["cbs"][0] if x["person"]["pid"] % 2 else None, "01/01/2020", shown(d)) for x in self.loans]
        writers.write_psv(folder / f"lms_borrower_{tag}.csv", ["borrower_id", "full_name", "dob", "pan", "mobile", "address", "city", "pincode", "cbs_cust_ref", "created_on", "updated_on"], people)
        loans, paid = [], []
        for i, x in enumerate(self.loans):
            if x["dpd"]:
                x["dpd"] += 1
            overdue = Decimal(x["dpd"]) * 10
            loans.append((x["id"], x["borrower"], x["product"], "BR001", "01/04/2022", x["principal"] * 2, Decimal("9.5"), 120, Decimal(9000), x["principal"], overdue, Decimal(0), "abc" if n == 1 and i == 0 else x["dpd"], "01/09/2026", "ACTIVE", "STANDARD", "N", "Y" if i == 3 else "N", shown(d)))
            if i % 4 == n % 4:
                paid.append((f"T{tag}{i:04d}", x["id"], shown(d), Decimal(9000), "NACH"))
                x["principal"] -= 5000
        writers.write_psv(folder / f"lms_loan_{tag}.csv", ["loan_id", "borrower_id", "product_code", "branch_code", "sanction_date", "sanction_amount", "interest_rate", "tenure_months", "emi_amount", "principal_outstanding", "principal_overdue", "interest_overdue", "dpd", "last_payment_date", "loan_status", "src_asset_class", "restructured_flag", "loss_flag", "as_of_date"], loans, sum(x[9] for x in loans))
        writers.write_psv(folder / f"lms_repayment_{tag}.csv", ["txn_id", "loan_id", "payment_date", "amount", "mode"], paid, sum((x[3] for x in paid), Decimal(0)), count=len(paid) + (1 if n == 2 else 0))
        writers.write_manifest(folder, "lms", day, [{"entity": "lms_borrower", "records": len(people)}, {"entity": "lms_loan", "records": len(loans), "control_field": "principal_outstanding", "control_total": str(sum(x[9] for x in loans))}, {"entity": "lms_repayment", "records": len(paid), "control_field": "amount", "control_total": str(sum((x[3] for x in paid), Decimal(0)))}])

    def _payments(self, folder: Path, day: str, n: int, tag: str) -> None:
        r, items = self.r, []

        def pay(account: str, direction: str, amount: object, channel: str, ccy: str = "INR") -> None:
            own, other = {"name": "Own", "account": {"number": account, "ifsc": f"{BANK}0000001"}}, {"name": "Other", "account": {"number": f"{r.randrange(10**13)}", "ifsc": "HDFC0000009"}}
            debtor, creditor = (own, other) if direction == "DR" else (other, own)
            x = {"msg_id": f"M{tag}{len(items):05d}", "end_to_end_id": f"E{len(items)}", "created_at": f"{day}T09:00:00+05:30", "value_date": day, "channel": channel, "direction": direction, "status": "SETTLED", "amount": {"value": amount, "ccy": ccy}, "debtor": debtor, "creditor": creditor, "charges": [{"type": "FEE", "amount": 5.0, "ccy": ccy}, {"type": "GST", "amount": 0.9, "ccy": ccy}]}
            if n >= 3:
                x["device"] = {"id": "d1", "os": "android"}
            items.append(x)

        for _ in range(len(self.accounts)):
            pay(r.choice(self.accounts)[0], r.choice(["DR", "CR"]), r.randrange(100, 20_000), r.choice(["UPI", "NEFT", "IMPS"]))
        if n in (1, 2, 3):
            pay(self.accounts[0][0], "CR", 45_000 + n, "CASH_DEPOSIT")
        if n == 4:
            for _ in range(8):
                pay(self.accounts[1][0], "CR", 10_000, "UPI")
            pay(self.accounts[1][0], "DR", 79_000, "RTGS")
        if n == 1:
            pay(self.accounts[2][0], "CR", 10, "UPI", "XYZ")
        items[0]["amount"].pop("value")
        items.append(items[5])
        writers.write_jsonl(folder / f"payments_{tag}.jsonl", items)
        total = sum(Decimal(str(x["amount"]["value"])) for x in items if "value" in x["amount"])
        writers.write_manifest(folder, "payments", day, [{"entity": "pay_transaction", "records": len(items), "control_field": "amount", "control_total": str(total)}])

    def _others(self, landing: Path, day: str, n: int, tag: str) -> None:
        crm = landing / "crm" / day
        items = [{"crm_id": f"CRM-{p['pid']:08x}", "profile": {"full_name": f"{p['last']} {p['first']}", "date_of_birth": str(p["dob"]) if p["pid"] % 2 else p["dob"].strftime("%d-%m-%Y"), "gender": "F"}, "identifiers": [{"type": "PAN", "value": p["pan"]}] if p["pid"] % 8 == 1 else [], "addresses": [{"type": "HOME", "line1": p["line"], "city": p["city"], "pincode": p["pin"]}], "contacts": {"email": f"{p['first'].lower()}{p['pid']}@mail.example.com", "mobile": p["mobile"]}, "updated_at": f"{day}T08:00:00+05:30"} for p in self.people if p["pid"] % 4 == 1]
        (crm / f"crm_customers_{tag}.json").write_text(json.dumps(items))
        writers.write_manifest(crm, "crm", day, [{"entity": "crm_customer", "records": len(items)}])
        docs = landing / "documents" / day
        c = self._row(7)
        (docs / f"mail_{tag}.eml").write_text(f"From: <{c['email']}>\nDate: {day}\nSubject: Change of address\n\nCustomer ID: {c['cust_id']}\nAddress: 9 New Rd., {c['city']} {c['pincode']}\n")
        (docs / f"kyc_{tag}.txt").write_text(f"KYC declaration\nCustomer ID: {c['cust_id']}\nDate of birth: {c['dob']}\nPAN: {c['pan']}\nSigned on: {day}\n")
        (docs / f"scan_{tag}.png").write_bytes(writers.png(48, 30))
        if n == 2:
            (docs / f"empty_{tag}.eml").write_text("")
        writers.write_manifest(docs, "documents", day, [{"entity": "doc_document", "records": 4 if n == 2 else 3}])
        listed = landing / "compliance" / day
        p = self.people[8]
        rows = [("WL000001", "OFAC_SDN", "SANCTION", f"{p['first']} {p['last']}", p["dob"].strftime("%d/%m/%Y"), p["pan"], "IN", "01/09/2026", "23/09/2026" if n >= 2 else None, "01/09/2026"), ("WL000002", "PEP_DOMESTIC", "PEP", "Nobody Known", "01/01/1950", None, "IN", "01/09/2026", None, "01/09/2026")]
        writers.write_psv(listed / f"aml_watchlist_{tag}.csv", ["entry_id", "list_name", "entry_type", "full_name", "dob", "pan", "nationality", "listed_on", "delisted_on", "updated_on"], rows)
        writers.write_manifest(listed, "compliance", day, [{"entity": "aml_watchlist", "records": 2}])

"""The batch of one business date: landing, bronze, silver, master data, gold, reconciliation, semantic layer.

Every stage checks that the stage before completed, reads what it needs as of its batch, computes with the pure operators,
and commits through the snapshot store; its state goes to the audit table at once, also when it fails.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import banking, standard
from ..functions.typing import source_instant, typed
from ..operators import aml, audit, cdc, contract, mdm, reconcile, scd2
from ..operators.relational import as_of, cut, latest, record_hash
from ..operators.store import Table
from ..sources import generator, readers
from ..sources.contracts import CONTRACTS
from . import consumers

STAGES = ("land", "bronze", "silver", "mdm", "gold", "recon", "semantic")
CURRENCIES = [("INR", "Indian Rupee", 1.0), ("USD", "US Dollar", 83.2), ("EUR", "Euro", 90.1), ("GBP", "Pound Sterling", 105.3)]
SOURCES = ("cbs", "lms", "payments", "crm", "documents", "compliance")
RECON = "batch_id string, layer string, check_name string, expected double, actual double, explained double, status string"
#: Entities that bronze reads at once.
AHEAD = 4
DRIFT = "batch_id string, entity string, file string, field string, drift string"


class Drill(RuntimeError):
    """A planted failure."""


class Lakehouse:
    def __init__(self, spark: SparkSession, root: str, landing: str, customers: int = 60, seed: int = 7):
        self.spark, self.root, self.landing, self.customers, self.seed = spark, root.rstrip("/"), landing.rstrip("/"), customers, seed
        self.steps = audit.TransformLog("", "")

    # tables and audit
    def table(self, layer: str, name: str) -> Table:
        return Table(self.spark, f"{self.root}/{layer}/{name}")

    def read(self, layer: str, name: str, batch: str | None = None) -> DataFrame | None:
        t = self.table(layer, name)
        found = t.read(batch=batch) if batch else None
        return found if found is not None else t.read()

    def audit(self) -> DataFrame:
        t = self.table("ref", "load_audit")
        t.ensure(audit.LOAD_AUDIT)
        return t.read()

    def log(self, batch: str, stage: str, entity: str, status: str, rows: tuple = (None, None, None), message: str | None = None) -> None:
        t = self.table("ref", "load_audit")
        t.ensure(audit.LOAD_AUDIT)
        t.append(self.spark.createDataFrame([(batch, stage, entity, status, *rows, message, datetime.now(timezone.utc).replace(tzinfo=None))], audit.LOAD_AUDIT).coalesce(1))

    def _logged(self, log: audit.TransformLog) -> None:
        t = self.table("ref", "transform_log")
        t.ensure(audit.TRANSFORM_LOG)
        if log.rows:
            t.append(self.spark.createDataFrame(log.rows, audit.TRANSFORM_LOG).coalesce(1), log.batch)

    def run(self, day: str, stages: tuple[str, ...] = STAGES, mode: str = "normal") -> None:
        for stage in stages:
            if stage == "land":
                self.land(day)
                continue
            before = STAGES[STAGES.index(stage) - 1]
            if before != "land":
                audit.require_completed(self.audit(), self.batch(day), before)
            self._staged(day, stage, lambda stage=stage: self.bronze(day, mode) if stage == "bronze" else getattr(self, stage)(day))

    def _staged(self, day: str, stage: str, work: Callable[[], None]) -> None:
        batch = self.batch(day)
        self.log(batch, stage, "*", "STARTED")
        self.steps = audit.TransformLog(batch, stage)
        try:
            work()
        except Exception as e:
            self.log(batch, stage, "*", "FAILED", message=audit.error_summary(e))
            raise
        finally:
            self._logged(self.steps)
        self.log(batch, stage, "*", "COMPLETED")

    @staticmethod
    def batch(day: str) -> str:
        return "B" + day.replace("-", "")

    # landing
    def land(self, day: str) -> None:
        """Files up to the day, by the seeded generator: for demonstrations and tests."""
        bank = generator.Bank(self.customers, self.seed)
        for d in generator.DATES[: generator.DATES.index(day) + 1]:
            bank.land(Path(self.landing.removeprefix("file://")), d)

    def manifest(self, source: str, day: str) -> dict | None:
        return readers.read_manifest(self.spark, f"{self.landing}/{source}/{day}/_manifest.json")

    # bronze
    def _raw(self, entity: str, day: str) -> DataFrame:
        c = CONTRACTS[entity]
        df = readers.raw_frame(self.spark, c, f"{self.landing}/{c['source']}/{day}")
        if entity == "doc_document":
            files = [(f["file"], f["bytes"], f["sha256"]) for f in self.manifest("documents", day)["files"]]
            df = readers.with_missing_files(df, self.spark.createDataFrame(files, "file string, bytes long, sha256 string")).dropDuplicates(["file_name"])
            kind = F.when(F.col("file_name").endswith(".png"), "SCAN").when(F.lower(F.coalesce("text_content", F.lit(""))).contains("kyc"), "KYC").otherwise("EML")
            df = df.withColumn("doc_type", kind).withColumn("bytes", F.col("bytes").cast("string"))
        return df

    def _rejects(self, entity: str) -> list[Column]:
        c = CONTRACTS[entity]
        out = [F.when(F.col("_parse_error").isNotNull(), F.lit("payload:MALFORMED_JSON"))] if c["format"] in ("jsonl", "json_array") else []
        if entity == "cbs_cdc_event":
            for name in ("customer", "account"):
                out += contract.image_checks(c, F.col("payload"), F.col("op"), F.col("table"), CONTRACTS[f"cbs_{name}"])
        if entity == "doc_document":
            out.append(F.when(F.col("content").isNull() & (F.col("bytes").cast("long") > 0), F.lit("content:NOT_READ")))
        return out

    def bronze(self, day: str, mode: str = "normal") -> None:
        """Mode: normal, resume, fail-during:entity or fail-after:entity."""
        batch, (kind, _, target) = self.batch(day), mode.partition(":")
        if kind not in ("normal", "resume", "fail-during", "fail-after"):
            raise ValueError(f"no mode {mode}")
        done = {r[0] for r in audit.resume_set(self.audit(), batch, "bronze").collect()} if kind == "resume" else set()
        manifests = {s: self.manifest(s, day) for s in SOURCES}
        for s, m in manifests.items():
            if m is None:
                self.log(batch, "bronze", s, "MISSING_MANIFEST")
        landed = [entity for entity, c in CONTRACTS.items() if (m := manifests[c["source"]]) is not None and entity in {e["entity"] for e in m["entities"]}]
        with ThreadPoolExecutor(AHEAD) as pool:  # many entities are few tasks; they are read and checked side by side and committed in order
            ahead = {entity: pool.submit(self._checked, entity, day) for entity in landed if entity not in done}
            try:
                for entity in landed:
                    if entity in done:
                        self.log(batch, "bronze", entity, "SKIPPED")
                        continue
                    files, counts = CONTRACTS[entity]["files"], self._ingest(entity, day, *ahead[entity].result(), fail=kind == "fail-during" and entity == target)
                    self.log(batch, "bronze", entity, "COMMITTED", counts)
                    self.steps.add(entity, "ingest", files, f"bronze.{entity}", counts[0], counts[1])
                    self.steps.add(entity, "validate", files, "bronze.quarantine", counts[0], counts[2])
                    if kind == "fail-after" and entity == target:
                        raise Drill(f"planted failure after {entity}")
            finally:
                for read in ahead.values():
                    if not read.cancel() and not read.exception():
                        read.result()[0].unpersist()

    def _checked(self, entity: str, day: str) -> tuple[DataFrame, tuple[int, int, int]]:
        """The entity's rows with what contracts say of them, cached, and their counts."""
        c = CONTRACTS[entity]
        raw = self._raw(entity, day).withColumns({"_batch_id": F.lit(self.batch(day)), "_business_date": F.lit(day).cast("date"), "_source_system": F.lit(c["source"]), "_ingested_at": F.current_timestamp()})
        checked = contract.validate(raw, c, self._rejects(entity)).cache()
        try:
            return checked, contract.counts(checked)
        except BaseException:
            checked.unpersist()
            raise

    def _ingest(self, entity: str, day: str, checked: DataFrame, counts: tuple[int, int, int], fail: bool) -> tuple[int, int, int]:
        c, batch = CONTRACTS[entity], self.batch(day)
        try:
            good, bad = contract.split(checked)
            if fail:
                good = good.withColumn("_ingested_at", F.coalesce(F.raise_error(F.lit(f"planted failure during {entity}")).cast("timestamp"), F.col("_ingested_at")))
            t = self.table("bronze", entity)
            self._put(t, good, ["_business_date"], day, batch)
            quarantine = bad.select(F.lit(entity).alias("_entity"), "_business_date", F.concat_ws(":", "_source_file", "_source_row").alias("_position"), "_record", "_reject_reasons")
            q = self.table("bronze", "quarantine")
            q.ensure("_entity string, _business_date date, _position string, _record string, _reject_reasons array<string>", ["_business_date", "_entity"])
            q.replace_partitions({"_business_date": day, "_entity": entity}, quarantine, batch)
            if c["format"] in ("jsonl", "json_array"):
                drift = contract.json_key_drift(checked, contract.known_keys(c)).select(F.lit(batch), F.lit(entity), "_source_file", "field", "drift").toDF(*[x.split()[0] for x in DRIFT.split(", ")])
                log = self.table("ref", "schema_drift")
                log.ensure(DRIFT)
                log.replace_rows(f"batch_id = '{batch}' AND entity = '{entity}'", drift, batch)
            return counts
        finally:
            checked.unpersist()

    @staticmethod
    def _put(t: Table, df: DataFrame, partition_by: list[str], day: str, batch: str) -> None:
        """A daily table's rows of the day; a day without rows loses those it had."""
        if t.exists:
            t.replace_partitions({partition_by[0]: day}, df, batch)
        else:
            t.create(df, partition_by, batch)

    def slice(self, layer: str, name: str, day: str) -> DataFrame | None:
        t = self.table(layer, name)
        column = "_business_date" if layer == "bronze" else "business_date"
        return t.read(partitions={column: day}) if t.exists else None

    # silver
    def _typed(self, entity: str, day: str) -> DataFrame | None:
        df = self.slice("bronze", entity, day)
        if df is None:
            return None
        position = F.concat_ws(":", "_source_file", F.col("_source_row").cast("string"))
        extra = [c for c in ("payload", "text_content", "content", "mime_type") if c in df.columns]
        return df.select(*contract.typed_columns(CONTRACTS[entity]), *extra, position.alias("_src_position"), "_source_row", F.col("_record_hash"), F.lit(self.batch(day)).alias("_src_batch_id"))

    def _state(self, name: str, rows: DataFrame, keys: list[str], day: str) -> None:
        batch = self.batch(day)
        self.steps.add(name, "standardise", f"bronze.{name}", f"silver.{name}")
        self.steps.add(name, "deduplicate", f"bronze.{name}", f"silver.{name}", details="newest row a key: " + ", ".join(keys))
        rows = rows.withColumns({"_src_batch_id": F.lit(batch), "_first_batch_id": F.lit(batch)})
        t = self.table("silver", name)
        if not t.exists:
            t.create(rows.where("NOT _is_deleted"), batch=batch)
        else:
            t.merge(rows.select(*t.read().columns), keys, batch)

    def silver(self, day: str) -> None:
        batch, d = self.batch(day), F.lit(day).cast("date")
        rates = self.spark.createDataFrame([(c, r) for c, _, r in CURRENCIES], "currency string, rate double")
        exceptions = []
        changes = self.slice("bronze", "cbs_cdc_event", day)
        for name, key in (("customer", "cust_id"), ("account", "acct_no"), ("branch", "branch_code"), ("product", "product_code")):
            c = CONTRACTS[f"cbs_{name}"]
            columns = [x["name"] for x in c["columns"]]
            parts = []
            snapshot = self._typed(f"cbs_{name}", day)
            stamp = source_instant(F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")) if "updated_at" in columns else F.to_timestamp(F.lit(f"{day} 00:00:00"))
            if snapshot is not None:
                parts.append(snapshot.select(*columns, stamp.alias("_src_ts"), "_src_position", F.lit(False).alias("_is_deleted"), F.lit(None).cast("string").alias("_src_op"), F.lit(0).cast("bigint").alias("_pos")))
            if changes is not None and name in ("customer", "account"):
                images = cdc.images(changes, c)
                first, again = cdc.resent(images)
                exceptions += [again, cdc.out_of_order(first, [key])]
                parts.append(first.select(*columns, "_src_ts", "_src_position", "_is_deleted", "_src_op", "_pos"))
            if not parts:
                continue
            both = parts[0]
            for p in parts[1:]:
                both = both.unionByName(p)
            rows = latest(both, [key], [F.desc("_src_ts"), F.desc("_pos")]).withColumn("_record_hash", record_hash([F.col(x) for x in [*columns, "_is_deleted"]]))
            if name == "customer":
                rows = rows.withColumn("full_name", F.concat_ws(" ", "first_name", "middle_name", "last_name")).withColumn("address", F.concat_ws(" ", "addr_line1", "addr_line2", "city", "pincode"))
                rows = standard.person(rows)
            if name == "account":
                rows = rows.withColumn("account_key", F.concat(F.lit("ACC:CBS:"), "acct_no"))
            target = self.read("silver", f"cbs_{name}")
            if target is not None and changes is not None and name in ("customer", "account"):
                exceptions.append(cdc.merge_exceptions(rows.where("_src_op IS NOT NULL"), target, [key]).withColumn("_source_row", F.lit(0)))
            self._state(f"cbs_{name}", rows.drop("_src_op", "_pos"), [key], day)
        self._extract("lms_borrower", ["borrower_id"], day, lambda df: standard.person(df).withColumn("borrower_key", F.concat(F.lit("BRW:LMS:"), "borrower_id")))
        self._extract("crm_customer", ["crm_id"], day, self._crm)
        self._extract("aml_watchlist", ["entry_id"], day, standard.person)
        daily = {
            "cbs_eod_balance": (["acct_no", "bal_date"], lambda df: banking.to_home_currency(banking.to_home_currency(df, rates, "ledger_balance", "currency", "balance_inr"), rates, "available_balance", "currency", "available_inr").withColumn("account_key", F.concat(F.lit("ACC:CBS:"), "acct_no"))),
            "lms_loan": (["loan_id"], lambda df: df.withColumns({"loan_key": F.concat(F.lit("LN:LMS:"), "loan_id"), "borrower_key": F.concat(F.lit("BRW:LMS:"), "borrower_id")})),
            "lms_repayment": (["txn_id"], lambda df: df.withColumn("loan_key", F.concat(F.lit("LN:LMS:"), "loan_id"))),
            "pay_transaction": (["msg_id"], lambda df: self._payment(df, rates)),
            "doc_document": (["file_name"], self._document),
        }
        for entity, (keys, build) in daily.items():
            df = self._typed(entity, day)
            if df is not None:
                self._put(self.table("silver", entity), build(latest(df, keys, [F.col("_source_row")])).withColumn("business_date", d), ["business_date"], day, batch)
        log = self.table("silver", "cdc_exception")
        log.ensure("business_date date, position string, exception string, action string", ["business_date"])
        rows = log.read().where("false")
        for x in exceptions:
            rows = rows.unionByName(x.select(d.alias("business_date"), F.col("_src_position").alias("position"), "exception", "action"))
        log.replace_partitions({"business_date": day}, rows, batch)

    def _extract(self, entity: str, keys: list[str], day: str, build: Callable[[DataFrame], DataFrame]) -> None:
        """A full extract: newest row a key, merged; keys that vanish stay."""
        df = self._typed(entity, day)
        if df is not None:
            rows = build(latest(df, keys, [F.col("_source_row")]))
            self._state(entity, rows.withColumns({"_src_ts": F.to_timestamp(F.lit(f"{day} 00:00:00")), "_is_deleted": F.lit(False)}).drop("_source_row", "payload"), keys, day)

    @staticmethod
    def _crm(df: DataFrame) -> DataFrame:
        at = lambda p: F.get_json_object("payload", f"$.{p}")
        ids = F.from_json(at("identifiers"), "array<struct<type:string,value:string>>")
        flat = df.withColumns({"pan": banking.json_value_by_type(ids, "PAN"), "mobile": at("contacts.mobile"), "gender": F.upper(F.substring(at("profile.gender"), 1, 1)), "address": F.concat_ws(" ", at("addresses[0].line1"), at("addresses[0].city"), at("addresses[0].pincode")), "dob": F.col("date_of_birth")})
        return standard.person(flat)

    @staticmethod
    def _payment(df: DataFrame, rates: DataFrame) -> DataFrame:
        at = lambda p: F.get_json_object("payload", f"$.{p}")
        charges = F.from_json(at("charges"), "array<struct<type:string,amount:double>>")
        flat = {f"{side}_{part}": at(f"{side}.{path}") for side in ("debtor", "creditor") for part, path in (("account", "account.number"), ("ifsc", "account.ifsc"), ("name", "name"))}
        out = df.withColumns({**flat, "fee_amount": banking.json_sum_by_type(charges, "FEE"), "gst_amount": banking.json_sum_by_type(charges, "GST"), "device_id": at("device.id")})
        return banking.own_side(banking.to_home_currency(out, rates, "amount", "currency", "amount_inr"), generator.BANK).drop("payload")

    @staticmethod
    def _document(df: DataFrame) -> DataFrame:
        found = banking.document_facts(df, "text_content")
        width, height = banking.png_size(F.col("content"))
        found = found.withColumns({"intent": banking.document_intent(F.col("mime_type"), F.col("text_content"), F.col("subject")), "width": F.when(F.col("mime_type") == "image/png", width), "height": F.when(F.col("mime_type") == "image/png", height)})
        return found.withColumn("status", banking.extraction_status(F.col("bytes"), F.col("mime_type"), F.col("width"), [F.col("cust_id"), F.col("acct_no"), F.col("pan")])).drop("content")

    # master data
    def candidates(self, batch: str) -> DataFrame:
        common = ["candidate_id", "src_system", "src_key", "full_name", "name_std", "name_key", "pan_std", "dob", "mobile_e164", "email_std", "address_std", "pincode_std", "segment", "kyc_status", "cbs_ref", "is_active", "record_ts"]
        parts = []
        for system, name, key in (("CBS", "cbs_customer", "cust_id"), ("LMS", "lms_borrower", "borrower_id"), ("CRM", "crm_customer", "crm_id")):
            df = self.read("silver", name, batch)
            have = set(df.columns)
            value = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
            made = {"candidate_id": F.concat(F.lit(f"{system}:"), F.col(key).cast("string")), "src_system": F.lit(system), "src_key": F.col(key).cast("string"), "dob": F.col("dob"), "cbs_ref": value("cbs_cust_ref"), "is_active": ~F.col("_is_deleted"), "record_ts": F.col("_src_ts")}
            parts.append(df.select(*[made.get(c, value(c)).alias(c) for c in common]))
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def mdm(self, day: str) -> None:
        batch = self.batch(day)
        found = cut(self.candidates(batch))
        decided = mdm.decide(mdm.matched(found)).select("id_a", "id_b", "rule", "decision", "score", "similarity")
        previous = self._previous("mdm", "party_xref", batch)
        links = decided
        if previous is not None:
            links = decided.unionByName(mdm.prior_links(previous, decided, found), allowMissingColumns=True)
        links = cut(links)
        labels = mdm.components(found.select(F.col("candidate_id").alias("node")), links.where("decision = 'MERGE'").select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
        xref = mdm.best_rule(mdm.assign(labels, previous), links).withColumnRenamed("node", "candidate_id")
        xref = cut(xref.join(found.select("candidate_id", "src_system", "src_key", "pan_std", "is_active"), "candidate_id"))
        self._all("mdm", "party_candidate", found, batch)
        self._all("mdm", "match_pair", links, batch)
        self.steps.add("match", "match", "mdm.party_candidate", "mdm.match_pair")
        self.steps.add("golden", "survive", "mdm.party_xref", "mdm.golden_party")
        self._all("mdm", "party_xref", xref, batch)
        self._all("mdm", "document_party", self._documents_of_parties(day, xref), batch)
        golden = self.golden(found, xref)
        self._all("mdm", "golden_party", golden.join(mdm.rollup(xref), "party_id"), batch)
        truth = self._truth()
        if truth is not None:
            self._all("mdm", "match_quality", mdm.quality(xref.select(F.col("candidate_id").alias("node"), "party_id"), truth).withColumn("batch_id", F.lit(batch)), batch)

    def _previous(self, layer: str, name: str, batch: str) -> DataFrame | None:
        """The table as the newest earlier batch left it."""
        t = self.table(layer, name)
        earlier = [r.batch_id for r in t.history().select("batch_id").collect() if r.batch_id and r.batch_id < batch] if t.exists else []
        return t.read(batch=max(earlier)) if earlier else None

    def _all(self, layer: str, name: str, df: DataFrame, batch: str) -> None:
        t = self.table(layer, name)
        t.replace(df, batch=batch) if t.exists else t.create(df, batch=batch)

    def _truth(self) -> DataFrame | None:
        truth = readers.read_manifest(self.spark, f"{self.landing}/_truth/persons.json")
        if truth is None:
            return None
        rows = [(f"{s.upper()}:{k}", p["pid"]) for p in truth["persons"] for s in ("cbs", "lms", "crm") for k in p[s]]
        return self.spark.createDataFrame(rows, "node string, person long")

    def _planted(self) -> DataFrame | None:
        """rule_code, subject (an account, or a watchlist entry), complete_on of the patterns that the generator says it planted."""
        truth = readers.read_manifest(self.spark, f"{self.landing}/_truth/persons.json")
        if truth is None or not truth["aml"]:
            return None
        return self.spark.createDataFrame([(p["rule"], p["subject"], p["complete_on"]) for p in truth["aml"]], "rule_code string, subject string, complete_on string")

    @staticmethod
    def golden(found: DataFrame, xref: DataFrame) -> DataFrame:
        rows = found.where("is_active").join(xref.select("candidate_id", "party_id"), "candidate_id")
        s = F.col("src_system")
        trust = F.when((s == "CBS") & (F.col("kyc_status") == "VERIFIED"), 0.0).when(s == "CBS", 2.0).when(s == "LMS", 3.0).otherwise(4.0)
        name_trust = F.when(s == "CBS", 0.0).when(s == "CRM", 1.0).otherwise(2.0)
        epoch = -F.coalesce(F.unix_timestamp("record_ts"), F.lit(0)).cast("double")
        zero = F.lit(0.0)
        order = {
            "full_name": ("name_std", name_trust, F.when(F.col("name_std").rlike(r"(^| )[A-Z]( |$)"), 1.0).otherwise(0.0), -F.length("name_std").cast("double")),
            "dob": ("dob", trust, epoch, zero),
            "pan": ("pan_std", trust, epoch, zero),
            "mobile": ("mobile_e164", epoch, trust, zero),
            "email": ("email_std", epoch, trust, zero),
            "address": ("address_std", name_trust, epoch, zero),
            "segment": ("segment", trust, epoch, zero),
            "kyc_status": ("kyc_status", F.when(F.col("kyc_status") == "VERIFIED", 0.0).otherwise(1.0), epoch, zero),
        }
        parts = [rows.select("party_id", F.lit(a).alias("attribute"), F.col(c).cast("string").alias("value"), o1.alias("o1"), o2.alias("o2"), o3.alias("o3"), "src_system", "src_key") for a, (c, o1, o2, o3) in order.items()]
        values = parts[0]
        for p in parts[1:]:
            values = values.unionByName(p)
        return mdm.survive(values, list(order))

    def _documents_of_parties(self, day: str, xref: DataFrame) -> DataFrame:
        docs = self.slice("silver", "doc_document", day).select("file_name", "cust_id", "acct_no")
        cbs = xref.where("src_system = 'CBS'").select(F.col("src_key").alias("cust_id"), "party_id")
        owner = self.read("silver", "cbs_account").select("acct_no", F.col("cust_id").cast("string").alias("owner"))
        by_id = docs.join(cbs, "cust_id", "left").withColumnRenamed("party_id", "by_id")
        by_account = by_id.join(owner, "acct_no", "left").join(cbs.toDF("owner", "by_account"), "owner", "left")
        via = F.when(F.col("by_id").isNotNull(), "CUSTOMER_ID").when(F.col("by_account").isNotNull(), "ACCOUNT")
        return by_account.select("file_name", F.coalesce("by_id", "by_account").alias("party_id"), via.alias("linked_via"))

    # gold
    def _step(self, name: str, rows: DataFrame, keys: list[str], tracked: list[str], day: str, held: DataFrame | None = None) -> DataFrame:
        t, batch = self.table("gold", name), self.batch(day)
        history = self.read("gold", name)
        self.steps.add(name, "historise", "silver", f"gold.{name}", details="tracked: " + ", ".join(tracked))
        out = cut(scd2.step(history, rows, keys, tracked, day, held))
        t.overwrite(out, batch) if t.exists else t.create(out, batch=batch)
        return t.read()

    def gold(self, day: str) -> None:
        batch, d = self.batch(day), F.lit(day).cast("date")
        xref = self.read("mdm", "party_xref", batch)
        by = lambda system, key, out: xref.where(F.col("src_system") == system).select(F.col("src_key").alias(key), F.col("party_id").alias(out))
        golden = self.read("mdm", "golden_party", batch)
        party_columns = ["full_name", "dob", "pan", "mobile", "email", "address", "segment", "kyc_status", "source_systems", "source_keys"]
        parties = golden.select("party_id", *party_columns)
        parties = parties.unionByName(parties.limit(0).unionByName(self.spark.createDataFrame([("UNKNOWN",)], "party_id string"), allowMissingColumns=True))
        parties = self._step("dim_party", parties, ["party_id"], party_columns, day)
        accounts = self.read("silver", "cbs_account", batch).where("NOT _is_deleted").withColumn("_owner", F.col("cust_id").cast("string")).join(by("CBS", "_owner", "party_id"), "_owner", "left").withColumn("_joint", F.col("joint_cust_id").cast("string")).join(by("CBS", "_joint", "joint_party_id"), "_joint", "left")
        accounts = accounts.select("account_key", "acct_no", F.coalesce("party_id", F.lit("UNKNOWN")).alias("party_id"), "joint_party_id", "product_code", "branch_code", "currency", "status", "open_date", "interest_rate")
        accounts = self._step("dim_account", accounts, ["account_key"], ["party_id", "joint_party_id", "product_code", "branch_code", "currency", "status", "interest_rate"], day)
        borrower = by("LMS", "borrower_id", "party_id")
        daily = self.slice("silver", "lms_loan", day)
        loans = daily.join(borrower, "borrower_id", "left").select("loan_key", "loan_id", F.coalesce("party_id", F.lit("UNKNOWN")).alias("party_id"), "product_code", "branch_code", "loan_status", "sanction_amount", "interest_rate")
        held = self.table("bronze", "quarantine").read(partitions={"_business_date": day, "_entity": "lms_loan"}).select(F.concat(F.lit("LN:LMS:"), F.get_json_object("_record", "$.loan_id")).alias("loan_key"))
        loans = self._step("dim_loan", loans, ["loan_key"], ["party_id", "product_code", "branch_code", "loan_status", "interest_rate"], day, held)
        products = self.read("silver", "cbs_product", batch).where("NOT _is_deleted").withColumn("deposit_type", F.when(F.col("product_type") == "SA", "SAVINGS").when(F.col("product_type") == "CA", "CURRENT").when(F.col("product_type") == "TD", "TERM")).withColumn("is_casa", F.coalesce(F.col("deposit_type").isin("SAVINGS", "CURRENT"), F.lit(False)))
        self._all("gold", "dim_product", products.select("product_code", "product_name", "product_type", "domain", "deposit_type", "is_casa", "base_rate"), batch)
        self._all("gold", "dim_branch", self.read("silver", "cbs_branch").where("NOT _is_deleted").select("branch_code", "ifsc", "branch_name", "city", "state", "region", "opened_on"), batch)
        self._all("gold", "dim_currency", self.spark.createDataFrame(CURRENCIES, "currency_code string, currency_name string, inr_rate double"), batch)
        self._all("gold", "dim_date", banking.calendar(self.spark, "2015-01-01", "2027-12-31"), batch)
        now = lambda df: df.where("is_current")
        role = lambda df, key, party, name, domain: df.select(F.col(party).alias("party_id"), F.col(key).alias("account_key"), F.lit(name).alias("role"), F.lit(domain).alias("domain"), d.alias("as_of_date"))
        bridge = role(now(accounts), "account_key", "party_id", "PRIMARY", "DEPOSITS").unionByName(role(now(accounts).where("joint_party_id IS NOT NULL"), "account_key", "joint_party_id", "JOINT", "DEPOSITS")).unionByName(role(now(loans), "loan_key", "party_id", "BORROWER", "LENDING"))
        self._all("gold", "bridge_party_account", bridge, batch)
        account_now = as_of(accounts, day).select("account_key", F.col("surrogate_key").alias("account_sk"), "party_id", "product_code", "branch_code")
        party_now = as_of(parties, day).select("party_id", F.col("surrogate_key").alias("party_sk"))
        balances = self.slice("silver", "cbs_eod_balance", day).join(account_now, "account_key", "left").withColumn("party_id", F.coalesce("party_id", F.lit("UNKNOWN"))).join(party_now, "party_id", "left").join(products.select("product_code", "deposit_type", "is_casa"), "product_code", "left")
        self._put(self.table("gold", "fact_deposit_balance_daily"), balances.select(banking.date_key(d).alias("date_key"), d.alias("business_date"), "party_id", "party_sk", "account_key", "account_sk", "product_code", "deposit_type", "is_casa", "branch_code", F.col("ledger_balance"), "balance_inr", F.col("_src_position").alias("src_position")), ["business_date"], day, batch)
        loan_now = as_of(loans, day).select("loan_key", F.col("surrogate_key").alias("loan_sk"), F.col("party_id"))
        cls = F.when(F.col("loan_status") == "CLOSED", "CLOSED").otherwise(banking.asset_class(F.col("dpd"), F.col("loss_flag") == "Y"))
        positions = daily.join(loan_now, "loan_key", "left").withColumn("party_id", F.coalesce("party_id", F.lit("UNKNOWN"))).join(party_now, "party_id", "left").withColumn("asset_class", cls)
        npa = F.col("asset_class").isin(*[k for k in banking.PROVISION if k != "STANDARD"])
        facts = positions.select(banking.date_key(d).alias("date_key"), d.alias("business_date"), "party_id", "party_sk", "loan_key", "loan_sk", "product_code", "branch_code", "dpd", banking.sma_status(F.col("dpd")).alias("sma_status"), "asset_class", npa.alias("is_npa"), F.when(npa, F.date_sub("as_of_date", (F.col("dpd") - banking.NPA_DPD).cast("int"))).alias("npa_since"), "principal_outstanding", "principal_overdue", "interest_overdue", banking.provision_rate(F.col("asset_class")).alias("provision_rate"), (F.regexp_replace("asset_class", r"_\d$", "") != F.col("src_asset_class")).alias("class_differs_from_source"), F.col("_src_position").alias("src_position"))
        self._put(self.table("gold", "fact_loan_position_daily"), facts, ["business_date"], day, batch)
        pay = self.slice("silver", "pay_transaction", day).where("account_key IS NOT NULL").join(account_now.drop("product_code"), "account_key", "left").withColumn("party_id", F.coalesce("party_id", F.lit("UNKNOWN"))).join(party_now, "party_id", "left")
        pay = pay.select(banking.date_key(d).alias("date_key"), d.alias("business_date"), "party_id", "party_sk", "msg_id", "account_key", "account_sk", "branch_code", "value_date", "channel", "direction", "status", F.col("amount_inr").alias("amount"), "fee_amount", "gst_amount", "counterparty_account", "is_on_us", F.col("_src_position").alias("src_position"))
        self._put(self.table("gold", "fact_payment"), pay, ["business_date"], day, batch)
        for fact in ("fact_deposit_balance_daily", "fact_loan_position_daily", "fact_payment"):
            self.steps.add(fact, "enrich", "silver", f"gold.{fact}")
        self._alerts(day, batch, account_now, parties)

    def _alerts(self, day: str, batch: str, account_now: DataFrame, parties: DataFrame) -> None:
        d = F.lit(day).cast("date")
        facts = self.table("gold", "fact_payment")
        dates = [x for x in facts.partition_values("business_date") if x <= day][-aml.STRUCTURING["days"] :] or [day]
        payments = facts.read(between=("business_date", dates[0], day)).withColumn("channel", F.when(F.col("channel") == "CASH_DEPOSIT", "CASH").otherwise(F.col("channel")))
        accounts = aml.structuring(payments, day).select("rule_code", F.col("account_key").alias("subject"), F.col("amount").cast("decimal(18,2)").alias("amount"), "evidence").unionByName(aml.pass_through(payments, day).select("rule_code", F.col("account_key").alias("subject"), F.col("amount").cast("decimal(18,2)").alias("amount"), "evidence"))
        accounts = accounts.join(account_now.select(F.col("account_key").alias("subject"), "party_id"), "subject", "left").withColumn("subject_type", F.lit("ACCOUNT"))
        people = as_of(parties, day).select("party_id", F.col("pan").alias("pan_std"), standard.name_key(F.col("full_name")).alias("name_key"), F.col("dob").cast("date").alias("dob"))
        listed = self.read("silver", "aml_watchlist", batch).select("entry_id", "pan_std", "name_key", "dob", "listed_on", "delisted_on")
        hits = aml.watchlist(people, listed, day).select("rule_code", F.col("party_id").alias("subject"), F.lit(None).cast("decimal(18,2)").alias("amount"), F.col("entry_id").alias("evidence"), "party_id", F.lit("PARTY").alias("subject_type"))
        alerts = accounts.unionByName(hits)
        severity = F.when(F.col("rule_code") == "AML-WL-01", "CRITICAL").otherwise("HIGH")
        t = self.table("gold", "fact_aml_alert")
        earlier = t.read() if t.exists else None
        seen = earlier.where(F.col("business_date") < d).select("rule_code", F.col("subject_key").alias("subject")) if earlier is not None else alerts.select("rule_code", "subject").limit(0)
        out = aml.with_novelty(alerts, seen).select(aml.alert_id(F.col("rule_code"), F.col("subject"), d).alias("alert_id"), d.alias("business_date"), "rule_code", severity.alias("severity"), "subject_type", F.col("subject").alias("subject_key"), F.coalesce("party_id", F.lit("UNKNOWN")).alias("party_id"), "amount", "evidence", "is_new")
        self._put(t, cut(out), ["business_date"], day, batch)

    # reconciliation
    def recon(self, day: str) -> None:
        batch, checks = self.batch(day), []
        quarantine = self.table("bronze", "quarantine").read(partitions={"_business_date": day})
        one = lambda v: self.spark.range(0, 1, 1, 1).select(F.lit(float(v)).alias("v"))

        def add(layer: str, check: DataFrame) -> None:
            checks.append(check.select(F.lit(batch).alias("batch_id"), F.lit(layer).alias("layer"), "check_name", "expected", "actual", "explained", "status"))

        manifests = {source: self.manifest(source, day) for source in SOURCES}
        entities = [(e["entity"],) for m in manifests.values() if m for e in m["entities"] if e["entity"] in CONTRACTS]
        runs = audit.latest_runs(self.audit().where((F.col("batch_id") == batch) & (F.col("stage") == "bronze"))).select("entity", "status")
        add("bronze", reconcile.run_checks(runs, self.spark.createDataFrame(entities, "entity string")))
        for source, m in manifests.items():
            for e in m["entities"] if m else []:
                name = e["entity"]
                good, bad = self.slice("bronze", name, day), quarantine.where(F.col("_entity") == name)
                both = good.select(F.lit(1).alias("x")).unionByName(bad.select(F.lit(1).alias("x")))
                add("bronze", reconcile.check(f"landed_records {name}", one(e["records"]), both.agg(F.count("*"))))
                if e.get("control_field"):
                    field = e["control_field"]
                    path = next((c.get("path", field) for c in CONTRACTS[name]["columns"] if c["name"] == field and "path" in c), field)
                    total = good.select(typed(F.col(field), "decimal").alias("x")).unionByName(bad.select(F.get_json_object("_record", f"$.{path}").try_cast("decimal(18,2)").alias("x"))).agg(F.sum("x"))
                    add("bronze", reconcile.check(f"control_total {name}", one(e["control_total"]), total))
                if CONTRACTS[name]["format"] == "psv":
                    stats = readers.psv_stats(self.spark, f"{self.landing}/{source}/{day}/{CONTRACTS[name]['files']}")
                    add("bronze", reconcile.check(f"file_trailer {name}", stats.agg(F.sum("trailer_count")), stats.agg(F.sum("data_lines"))))
        for name in ("cbs_eod_balance", "lms_loan", "lms_repayment", "pay_transaction"):
            good, silver, keys = self.slice("bronze", name, day), self.slice("silver", name, day), CONTRACTS[name]["key"]
            left_out = good.dropDuplicates(keys).agg(F.count("*").alias("k")).crossJoin(good.agg(F.count("*").alias("n"))).select(F.col("k") - F.col("n"))  # single rows
            add("silver", reconcile.check(f"silver_records {name}", good.agg(F.count("*")), silver.agg(F.count("*")), left_out))
            amount = {"cbs_eod_balance": "ledger_balance", "lms_loan": "principal_outstanding", "lms_repayment": "amount", "pay_transaction": "amount"}[name]
            numbers = good.withColumn("_amount", typed(F.col(amount), "decimal"))
            add("silver", reconcile.deduplicated_total(f"silver_total {name}", numbers, silver, keys, [F.col("_source_row")], "_amount", amount))
        for fact, name, amount, total in (("fact_deposit_balance_daily", "cbs_eod_balance", "balance_inr", "balance_inr"), ("fact_loan_position_daily", "lms_loan", "principal_outstanding", "principal_outstanding"), ("fact_payment", "pay_transaction", "amount_inr", "amount")):
            silver, gold = self.slice("silver", name, day), self.slice("gold", fact, day)
            lost = silver.where("account_key IS NULL") if name == "pay_transaction" else silver.where("false")
            add("gold", reconcile.check(f"gold_records {fact}", silver.agg(F.count("*")), gold.agg(F.count("*")), lost.agg(-F.count("*"))))
            add("gold", reconcile.check(f"gold_total {fact}", silver.agg(F.sum(amount)), gold.agg(F.sum(total)), lost.agg(-F.coalesce(F.sum(amount).cast("double"), F.lit(0.0)))))
            add("gold", reconcile.check(f"dimension_link {fact}", one(0), gold.where("party_sk IS NULL").agg(F.count("*"))))
        unknown = self.slice("gold", "fact_deposit_balance_daily", day).where("party_id = 'UNKNOWN'")
        why = consumers.unresolved(self, day).where("why IS NOT NULL")
        add("gold", reconcile.check("party_resolved fact_deposit_balance_daily", one(0), unknown.agg(F.count("*")), unknown.join(why.select("account_key"), "account_key", "left_semi").agg(F.count("*"))))
        planted = self._planted()
        if planted is not None:
            alerts = self.read("gold", "fact_aml_alert").where(F.col("business_date") <= F.lit(day).cast("date")).withColumn("subject", F.when(F.col("subject_type") == "PARTY", F.col("evidence")).otherwise(F.col("subject_key")))
            add("gold", reconcile.truth_checks(planted, F.col("complete_on") <= day, alerts, F.col("business_date") == F.lit(day).cast("date")))
        out = checks[0]
        for c in checks[1:]:
            out = out.unionByName(c)
        t = self.table("ref", "recon_results")
        t.ensure(RECON, ["batch_id", "layer"])
        t.replace_partitions({"batch_id": batch, "layer": "gold"}, out, batch)

    # semantic layer
    def semantic(self, day: str) -> None:
        """Indicators of the date from gold alone, each from one certified view."""
        batch = self.batch(day)
        loans, deposits = self.read("gold", "fact_loan_position_daily", batch), self.read("gold", "fact_deposit_balance_daily", batch)
        npa = loans.groupBy("business_date").agg(F.sum("principal_outstanding").cast("double").alias("gross_advances"), F.sum(F.when(F.col("is_npa"), F.col("principal_outstanding")).otherwise(0)).cast("double").alias("gross_npa"), F.sum(F.col("principal_outstanding") * F.col("provision_rate")).cast("double").alias("provision"))
        casa = deposits.groupBy("business_date").agg(F.sum("balance_inr").cast("double").alias("deposits"), F.sum(F.when(F.col("is_casa"), F.col("balance_inr")).otherwise(0)).cast("double").alias("casa"))
        out = npa.join(casa, "business_date").withColumns({"gross_npa_ratio": F.round(F.col("gross_npa") / F.col("gross_advances"), 6), "casa_ratio": F.round(F.col("casa") / F.col("deposits"), 6)})
        self._all("semantic", "kpi_trend", out, batch)
        self.steps.add("kpi_trend", "aggregate", "gold", "semantic.kpi_trend")
        self.steps.add("regulatory", "consume", "gold", "semantic")
        consumers.load(self, day)
        t = self.table("ref", "recon_results")
        t.ensure(RECON, ["batch_id", "layer"])
        t.replace_partitions({"batch_id": batch, "layer": "semantic"}, consumers.kpi_checks(self, day).select(F.lit(batch).alias("batch_id"), F.lit("semantic").alias("layer"), "check_name", "expected", "actual", "explained", "status"), batch)


def live_match(records: list[dict], spark: SparkSession) -> DataFrame:
    """Ad-hoc customer records through the same standardisation, matching and survivorship."""
    columns = ("src_system", "src_key", "full_name", "dob", "pan", "mobile", "email", "address", "segment", "kyc_status", "cbs_ref")
    rows = spark.createDataFrame([tuple(r.get(c) for c in columns) for r in records], ", ".join(f"{c} string" for c in columns))
    found = standard.person(rows).withColumns({"candidate_id": F.concat_ws(":", "src_system", "src_key"), "dob": F.to_date("dob"), "is_active": F.lit(True), "record_ts": F.current_timestamp()})
    pairs = mdm.decide(mdm.matched(found))
    labels = mdm.components(found.select(F.col("candidate_id").alias("node")), pairs.where("decision = 'MERGE'").select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    return Lakehouse.golden(found, mdm.assign(labels).withColumnRenamed("node", "candidate_id"))


def load_records(path: str) -> list[dict]:
    return json.loads(Path(path).read_text())

"""Contracts of the landing entities.

One line a column: name, type, then any of R (required), reject or warn (severity of pattern and allowed), min=..., path=...,
fmt=...;..., in=a;b, and re=pattern (last, to the line's end).
"""

from __future__ import annotations

#: entity: (source, format, key, file glob, dump table, control column, columns)
_SPECS = {
    "cbs_branch": ("cbs", "mysqldump", "branch_code", "cbs_dump_*.sql", "branch", None, """
        branch_code string R reject re=^BR[0-9]{3}$
        ifsc string R reject re=^[A-Z]{4}0[A-Z0-9]{6}$
        branch_name string R
        city string R
        state string
        region string in=NORTH;SOUTH;EAST;WEST
        opened_on date"""),
    "cbs_product": ("cbs", "mysqldump", "product_code", "cbs_dump_*.sql", "product", None, """
        product_code string R
        product_name string R
        product_type string R in=SA;CA;TD;HL;PL;AL;BL
        domain string R in=DEPOSITS;LENDING
        base_rate decimal"""),
    "cbs_customer": ("cbs", "mysqldump", "cust_id", "cbs_dump_*.sql", "customer", None, """
        cust_id int R
        title string in=MR;MRS;MS;DR
        first_name string R
        middle_name string
        last_name string R
        dob date R
        gender string in=M;F;O
        pan string re=^[A-Z]{5}[0-9]{4}[A-Z]$
        aadhaar string re=^[0-9]{12}$
        mobile string re=^[+]?[0-9 -]{10,16}$
        email string re=^[^@ ]+@[^@ ]+[.][a-z]+$
        addr_line1 string R
        addr_line2 string
        city string R
        state string
        pincode string re=^[0-9]{6}$
        kyc_status string in=VERIFIED;PENDING;EXPIRED
        segment string in=MASS;AFFLUENT;PRIVATE
        home_branch string R
        created_at timestamp
        updated_at timestamp R"""),
    "cbs_account": ("cbs", "mysqldump", "acct_no", "cbs_dump_*.sql", "account", None, """
        acct_no string R reject re=^[0-9]{14}$
        cust_id int R
        joint_cust_id int
        product_code string R
        branch_code string R
        currency string in=INR;USD;EUR;GBP
        open_date date R
        status string R in=ACTIVE;DORMANT;CLOSED
        close_date date
        interest_rate decimal
        updated_at timestamp R"""),
    "cbs_cdc_event": ("cbs", "jsonl", "binlog_file,binlog_pos", "cbs_cdc_*.jsonl", None, None, """
        op string R path=op in=c;u;d reject
        ts_ms bigint R path=ts_ms
        table string R path=source.table in=customer;account reject
        binlog_file string R path=source.file
        binlog_pos bigint R path=source.pos"""),
    "cbs_eod_balance": ("cbs", "psv", "acct_no,bal_date", "cbs_eod_balance_*.csv", None, "ledger_balance", """
        acct_no string R reject re=^[0-9]{14}$
        bal_date date R
        ledger_balance decimal R
        available_balance decimal
        currency string R in=INR;USD;EUR;GBP"""),
    "lms_borrower": ("lms", "psv", "borrower_id", "lms_borrower_*.csv", None, None, """
        borrower_id string R reject re=^LB[0-9]{6}$
        full_name string R
        dob date R fmt=dd/MM/yyyy
        pan string re=^[A-Za-z]{5}[0-9]{4}[A-Za-z]$
        mobile string re=^[+]?[0-9 -]{10,16}$
        address string R
        city string
        pincode string re=^[0-9]{6}$
        cbs_cust_ref int
        created_on date fmt=dd/MM/yyyy
        updated_on date R fmt=dd/MM/yyyy"""),
    "lms_loan": ("lms", "psv", "loan_id,as_of_date", "lms_loan_*.csv", None, "principal_outstanding", """
        loan_id string R reject re=^LN[0-9]{8}$
        borrower_id string R
        product_code string R
        branch_code string R
        sanction_date date R fmt=dd/MM/yyyy
        sanction_amount decimal R
        interest_rate decimal
        tenure_months int
        emi_amount decimal
        principal_outstanding decimal R
        principal_overdue decimal
        interest_overdue decimal
        dpd int R
        last_payment_date date fmt=dd/MM/yyyy
        loan_status string R in=ACTIVE;CLOSED
        src_asset_class string in=STANDARD;SUBSTANDARD;DOUBTFUL;LOSS;CLOSED
        restructured_flag string in=Y;N
        loss_flag string in=Y;N
        as_of_date date R fmt=dd/MM/yyyy"""),
    "lms_repayment": ("lms", "psv", "txn_id", "lms_repayment_*.csv", None, "amount", """
        txn_id string R
        loan_id string R
        payment_date date R fmt=dd/MM/yyyy
        amount decimal R
        mode string in=NACH;BRANCH_CASH;PREPAYMENT;UPI;NEFT"""),
    "pay_transaction": ("payments", "jsonl", "msg_id", "payments_*.jsonl", None, "amount", """
        msg_id string R path=msg_id
        created_at string R path=created_at re=^[0-9]{4}-[0-9]{2}-[0-9]{2}T
        value_date date R path=value_date
        channel string R path=channel in=UPI;IMPS;NEFT;RTGS;CARD;CASH_DEPOSIT;SWIFT reject
        direction string R path=direction in=DR;CR reject
        status string R path=status in=SETTLED;REJECTED;RETURNED
        amount decimal R path=amount.value
        currency string R path=amount.ccy in=INR;USD;EUR;GBP reject
        debtor_account string R path=debtor.account.number
        creditor_account string R path=creditor.account.number"""),
    "crm_customer": ("crm", "json_array", "crm_id", "crm_customers_*.json", None, None, """
        crm_id string R path=crm_id reject re=^CRM-[0-9a-f]{8}$
        full_name string R path=profile.full_name
        date_of_birth date R path=profile.date_of_birth fmt=yyyy-MM-dd;dd-MM-yyyy
        email string path=contacts.email re=^[^@ ]+@[^@ ]+[.][a-z]+$
        updated_at string R path=updated_at re=^[0-9]{4}-[0-9]{2}-[0-9]{2}T"""),
    "doc_document": ("documents", "binary", "file_name", "*", None, None, """
        file_name string R
        doc_type string R in=EML;KYC;SCAN
        bytes bigint R min=1 reject
        sha256 string R"""),
    "aml_watchlist": ("compliance", "psv", "entry_id", "aml_watchlist_*.csv", None, None, """
        entry_id string R reject re=^WL[0-9]{6}$
        list_name string R in=UN_SANCTIONS;MHA_UAPA;OFAC_SDN;PEP_DOMESTIC reject
        entry_type string R in=SANCTION;PEP reject
        full_name string R
        dob date fmt=dd/MM/yyyy
        pan string re=^[A-Za-z]{5}[0-9]{4}[A-Za-z]$
        nationality string
        listed_on date R fmt=dd/MM/yyyy
        delisted_on date fmt=dd/MM/yyyy
        updated_on date R fmt=dd/MM/yyyy"""),
}


def _column(line: str) -> dict:
    line, _, pattern = line.strip().partition(" re=")
    name, kind, *rest = line.split()
    out: dict = {"name": name, "type": kind}
    if pattern:
        out["pattern"] = pattern
    for word in rest:
        key, _, value = word.partition("=")
        if word == "R":
            out["required"] = True
        elif word in ("reject", "warn"):
            out["severity"] = word
        elif key == "min":
            out["min"] = float(value)
        elif key == "path":
            out["path"] = value
        elif key == "fmt":
            out["formats"] = value.split(";")
        elif key == "in":
            out["allowed"] = value.split(";")
        else:
            raise ValueError(f"{name}: {word}")
    return out


CONTRACTS = {
    entity: {"entity": entity, "source": source, "format": kind, "key": key.split(","), "files": files, "table": table, "control": control, "columns": [_column(x) for x in columns.strip().splitlines()]}
    for entity, (source, kind, key, files, table, control, columns) in _SPECS.items()
}

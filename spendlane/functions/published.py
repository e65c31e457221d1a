"""Published column names of the spend report."""

# --- fixed values: report column -> published name, in published order ---
PUBLISHED_NAMES = {
    "invoice_date_time": "Invoice Date Time",
    "invoice_expeditor": "INVOICE EXPEDITOR",
    "invoice_expeditor_line": "INVOICE EXPEDITOR LINE",
    "billing_line_description": "Billing Line Description",
    "internal_reference": "Internal Reference",
    "billing_code": "Billing Code",
    "invoice_date": "Invoice Date",
    "billing_amount": "Billing Amount",
    "usd_average_exchange_rate": "USD Average Exchange Rate",
    "billing_amount_usd": "Billing Amount USD",
    "final_volume": "Final Volume",
    "final_chweight": "Final ChWeight",
    "actual_weight": "Actual Weight",
    "billing_client_id": "Billing Client ID",
    "billing_client_name": "Billing Client Name",
    "gci_and_billing_client_name": "GCI and Billing Client Name",
    "billing_currency": "Billing Currency",
    "billing_branch_code": "Billing Branch Code",
    "customer_invoice_type": "Customer Invoice Type",
    "billing_master_client_number": "Billing Master Client Number",
    "billing_master_client_name": "Billing Master Client Name",
    "invoice_year": "Invoice Year",
    "invoice_month": "Invoice Month",
    "billing_branch_country_name": "Billing Branch Country Name",
    "ship_mode": "Ship Mode",
    "billing_client_usage_distinction_type": "Billing Client Usage Distinction Type",
    "f2f_flag": "F2F Flag",
    "bill_to_customer_flag": "Bill To Customer Flag",
    "charge_type": "Charge Type",
    "invoice_month_number": "Invoice Month Number",
    "po": "PO",
    "origin_branch": "Origin Branch",
    "destination_country": "Destination Country",
    "service_type_code": "Service Type Code",
    "final_lane": "Final Lane",
    "final_shipper": "Final Shipper",
    "house_bill": "House Bill",
    "hb_count": "HB Count",
    "final_consignee": "Final Consignee",
    "final_origin_branch": "Final Origin Branch",
    "final_destination_branch": "Final Destination Branch",
    "final_service_level": "Final Service Level",
    "we_move_yn": "We Move YN",
    "freight": "Freight",
    "ship_date": "Ship Date",
    "arrival": "Arrival",
    "delivery": "Delivery",
    "eda": "EDA",
    "edi": "EDI",
    "eds": "EDS",
    "proof_of_delivery": "Proof of Delivery",
    "bkd": "BKD",
    "month": "Month",
    "quarter": "QUARTER",
    "year": "YEAR",
    "shipper_address1": "Shipper Address1",
    "shipper_address2": "Shipper Address2",
    "shipper_state": "Shipper_State",
    "shipper_city": "Shipper_City",
    "consignee_address1": "Consignee Address1",
    "consignee_address2": "Consignee Address2",
    "consignee_state": "Consignee State",
    "consignee_city": "Consignee_City",
    "invoice_month2": "Invoice Month2",
    "invoice_quarter": "Invoice Quarter",
    "hazard_flag": "Hazard Flag",
    "origin_branch_region_code": "Origin Branch Region Code",
    "destination_branch_region_code": "Destination Branch Region Code",
    "container_count": "Container Count",
    "containers": "Containers",
    "container_sizes": "Container Sizes",
    "qty": "QTY",
    "en_reference": "EN Reference",
    "ci_reference": "CI Reference",
    "mb_reference": "MB Reference",
    "dp_reference": "DP Reference",
}

"""Names, thresholds, word lists, patterns and message texts.

They decide what the reports say, so they are listed here together and in their
natural order, and every one of them can be overridden by a function argument.
"""

# --- statuses -------------------------------------------------------------------
PAID_STATUSES = ("paid", "completed", "done", "success")
CANCEL_STATUSES = ("cancelled", "canceled", "cancel")
COUNTED_ORDER_STATUSES = ("paid", "refunded")
CANCELLED_ORDER_STATUSES = ("cancelled",)
REPORT_ORDER_STATUSES = ("paid", "shipped")
EXCLUDED_CATEGORIES = ("test", "demo")
CRM_CLOSED_STATUSES = ("Закрыта", "Отказ", "Продажа")
CRM_HIGH_PRIORITY = ("Высокий", "Критичный")
CRM_HOT_PRIORITY = ("Высокий",)
WON_STATUS = "won"

# --- thresholds -----------------------------------------------------------------
TARGET_CPA = 3500
MIN_ROAS = 3.0
BAD_CAMPAIGN_COST = 10_000
CRM_LARGE_AMOUNT = 150_000
CRM_STALE_DAYS = 3
STOCK_LOW_UNITS = 5
STOCK_LOW_DAYS = 3
STOCK_NO_SALES_DAYS = 999
STOCK_MIN_MARGIN_RATE = 0.15
ATTRIBUTION_WINDOW_DAYS = 30
ATTRIBUTION_LOOKBACK_DAYS = 8
FAQ_MIN_SCORE = 2

# --- risk weights of a CRM request ------------------------------------------------
CRM_RISK_WEIGHTS = {
    "is_overdue_action": 3,
    "is_overdue_close": 2,
    "is_without_manager": 2,
    "is_stale": 2,
    "is_high_priority": 1,
    "is_large_amount": 1,
}

# --- patterns -------------------------------------------------------------------
EMAIL_PATTERN = r"^[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}$"
LOOSE_EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
# Address of a site form: dot-separated local part, domain labels that begin and end with a letter or digit.
STRICT_EMAIL_PATTERN = r"^[a-z0-9!#$%&'*+/=?^_`{|}~-]+(\.[a-z0-9!#$%&'*+/=?^_`{|}~-]+)*@([a-z0-9]([a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}$"
FAQ_TOKEN_PATTERN = r"[a-zа-я0-9]+"
FAQ_STOP_WORDS = ("как", "где", "что", "когда", "можно", "нужно", "по", "на", "и", "в")

# --- lead form limits: field -> (min length, max length) ---------------------------
LEAD_LENGTHS = {
    "name": (2, 120),
    "phone": (7, 30),
    "service": (2, 160),
    "comment": (0, 2000),
}

# --- CPA networks: name -> is the tracker name searched as well as the parameters ----
CPA_NETWORKS = {
    "scaleo": True,
    "perfluence": True,
    "admitad": False,
    "advcake": False,
    "cityads": False,
}
CPA_UNKNOWN_PARTNER = "Unknown (source: Advertisement Engine)"
CPA_UNKNOWN_SOURCE = "scaleo_w2a"
CPA_PARTNERS = ("Scaleio", "Perfluence")  # spelling as in the partner names
CPA_UNKNOWN_PARAMETERS = ("scaleo", "=cpa")
CPA_BYPASS_FLAG = "w2a"
CPA_TRAFFIC_TYPE = "app"
CPA_CHANNEL = "PAID.CPA"
CPA_CAMPAIGN = "ua"
CPA_OS = {"ios": "ios", "android": "aos"}
WEB_FLAG = "web"

# --- labels ---------------------------------------------------------------------
NO_MANAGER = "Не назначен"
DEFAULT_CLIENT = "Клиент"
NO_DATE = "—"
DEDUP_REASON = "phone/email/name_city match"
OPERATOR_PHRASE = "связаться с оператором"
OPERATOR_INTENT = "operator_request"
UNKNOWN_INTENT = "unknown"
UNKNOWN_ANSWER = "Я не нашел точный ответ. Передаю вопрос оператору."
PRIORITY_RANK = {"critical": 1, "high": 2, "normal": 3, "low": 4}
PRIORITY_RANK_OTHER = 9
PRIORITY_MARK = {"critical": "🚨", "high": "⚠️", "normal": "ℹ️", "low": "🔹"}
PRIORITY_MARK_OTHER = "ℹ️"

AD_KPI_TITLES = {
    "spend": "Расход",
    "leads": "Заявки",
    "cpl": "CPL",
    "cpa": "CPA",
    "roas": "ROAS",
    "revenue": "Выручка",
}
SALES_KPI_TITLES = {
    "revenue": "Выручка",
    "orders": "Заказы",
    "avg_check": "Средний чек",
    "new_clients": "Новые клиенты",
    "cancels": "Отмены",
}
CLIENT_QUALITY_TITLES = {
    "rows": "Строк в сырой базе",
    "duplicates": "Найдено дублей",
    "valid_phones": "Валидных телефонов",
    "valid_emails": "Валидных email",
    "contact_quality": "Качество контактов, %",
}

# --- report messages --------------------------------------------------------------
AD_ALERTS = {
    "leads_down": "Количество заявок снизилось больше чем на 15% к предыдущему дню",
    "cpl_up": "CPL вырос больше чем на 20%",
    "cpa_up": "CPA вырос больше чем на 20%",
    "roas_low": "ROAS ниже целевого значения %.1fx",
    "roas_down": "ROAS просел больше чем на 20%",
    "bad_campaigns": "Найдено кампаний с риском слива бюджета: %d",
    "none": "Критичных отклонений не найдено",
}
SALES_ALERTS = {
    "revenue_down": "Выручка просела больше чем на 15% к предыдущему дню",
    "orders_down": "Количество заказов снизилось больше чем на 15%",
    "avg_check_down": "Средний чек снизился больше чем на 10%",
    "cancels_up": "Количество отмен выше предыдущего дня",
    "none": "Критичных отклонений не найдено",
}
CRM_ALERTS = {
    "hot_overdue": "Высокоприоритетных просрочек: %d",
    "without_manager": "Заявок без ответственного: %d",
    "stale": "Зависших заявок без движения: %d",
    "risk_amount": "Сумма в зоне риска: %s ₽",
    "none": "Критичных просрочек не найдено",
}
CRM_REASONS = {
    "is_overdue_action": "просрочено следующее действие",
    "is_overdue_close": "просрочен дедлайн закрытия",
    "is_without_manager": "нет ответственного",
    "is_stale": "статус давно не менялся",
    "is_hot_overdue": "высокий приоритет",
}
CRM_PROBLEMS = {
    "hot_action": "Критично: просрочено действие по горячей заявке",
    "action": "Просрочено следующее действие",
    "close": "Просрочен дедлайн закрытия",
    "no_manager": "Нет ответственного",
    "stale": "Заявка зависла в статусе",
    "other": "Проверить",
}
STOCK_ALERT_LINE = "• %s / %s: %s — доступно %d, статус %s"
AD_CHANNEL_LINE = "• %s: %s ₽  лиды %d  продажи %d  ROMI %s%%"
NOTIFICATION_TEXT = "%s %s\n\nТип: %s\nОбъект: %s\nОтветственный: %s\nПриоритет: %s\n\n%s"
BOT_LEAD_TEXT = (
    "🆕 Новая заявка\n\nID: %s\nУслуга: %s\nБюджет: %s\nКлиент: %s\nТелефон: %s\n"
    "Email: %s\n\nКомментарий: %s"
)
SITE_LEAD_TEXT = (
    "🆕 Новая заявка с сайта\n\nID: %s\nУслуга: %s\nКлиент: %s\nТелефон: %s\nEmail: %s\n\n"
    "Комментарий: %s\n\nUTM: %s / %s / %s\nСтраница: %s"
)
TICKET_TEXT = (
    "⚠️ Вопрос передан оператору\n\nID: %s\nКлиент: %s\nКанал: %s\nТема: %s\n\nВопрос: %s"
)

# --- column descriptions ------------------------------------------------------------
CLIENT_DICTIONARY = {
    "client_uid": "Стабильный ID клиента после дедупликации",
    "client_id": "ID выбранной мастер-записи из сырой базы",
    "full_name": "Нормализованное ФИО",
    "phone": "Телефон в формате +7XXXXXXXXXX",
    "email": "Email в нижнем регистре без лишних пробелов",
    "city": "Нормализованный город",
    "primary_source": "Источник из мастер-записи",
    "total_orders": "Количество заказов в мастер-записи",
    "revenue_rub": "Выручка по клиенту в рублях",
    "raw_records_in_group": "Сколько сырых строк было объединено в клиента",
    "merged_client_ids": "Список сырых ID, объединенных в одну запись",
}
SALES_DICTIONARY = {
    "order_date": ("Дата заказа", "date"),
    "order_month": ("Месяц заказа для группировки в BI", "string"),
    "order_week": ("ISO-неделя заказа", "string"),
    "order_id": ("Идентификатор заказа", "string"),
    "customer_id": ("Идентификатор клиента", "string"),
    "customer_name": ("Название/имя клиента", "string"),
    "city": ("Город клиента", "string"),
    "customer_type": ("Тип клиента: B2B или B2C", "string"),
    "sales_channel": ("Канал продажи", "string"),
    "payment_method": ("Способ оплаты", "string"),
    "order_status": ("Статус заказа", "string"),
    "product_id": ("Идентификатор товара/услуги", "string"),
    "product_name": ("Товар или услуга", "string"),
    "category": ("Категория товара/услуги", "string"),
    "quantity": ("Количество в строке заказа", "integer"),
    "gross_revenue": ("Выручка до скидки", "number"),
    "discount_amount": ("Сумма скидки", "number"),
    "net_revenue": ("Выручка после скидки", "number"),
    "cost": ("Себестоимость", "number"),
    "margin": ("Маржа", "number"),
    "margin_pct": ("Маржинальность", "number"),
    "is_paid": ("Флаг оплаченного/учитываемого заказа", "integer"),
    "order_sequence": ("Порядковый номер покупки клиента", "integer"),
    "is_repeat_purchase": ("Флаг повторной покупки", "integer"),
    "order_total": ("Сумма заказа после скидки", "number"),
    "avg_check": ("Средний чек заказа", "number"),
}

# Outcomes of handing a lead to a channel; of two at the same moment the later in this list counts.
DELIVERY_STATUSES = ("queued", "skipped", "error", "sent")
DELIVERY_CHANNELS = ("crm", "telegram", "sheets")

"""Codes, labels and calendar dates every result has to agree on.

These are plain data. They are listed once, in their natural order, and the rest
of the package refers to them by name.
"""

# --- vocabularies ----------------------------------------------------------

ORDER_STATUSES = (
    "new",
    "paid",
    "shipped",
    "ready_for_pickup",
    "delivered",
    "cancelled",
    "returned",
    "refunded",
)

PAYMENT_STATUSES = ("success", "failed", "refunded")

# An order in one of these states is closed for good.
CLOSED_STATUSES = ("delivered", "cancelled", "refunded")

# An order in one of these states can still move; cancelled and returned orders
# can move too when there is money to give back.
MOVING_STATUSES = ("new", "paid", "shipped", "ready_for_pickup", "delivered")
AWAITING_REFUND_STATUSES = ("cancelled", "returned")

# --- labels ----------------------------------------------------------------

CHANNEL_LABELS = {
    "telegram_ads": "Реклама в Telegram",
    "yandex_direct": "Яндекс.Директ",
    "vk_ads": "Реклама во ВКонтакте",
    "social": "Прочие соцсети",
    "referral": "Рекомендации",
    "email": "Email-рассылка",
    "organic": "Прямые заходы",
}

ORDER_STATUS_LABELS = {
    "new": "Создан",
    "paid": "Оплачен",
    "shipped": "Отправлен",
    "ready_for_pickup": "Готов к выдаче",
    "delivered": "Доставлен",
    "cancelled": "Отменён",
    "returned": "Возвращён",
    "refunded": "Возмещён",
}

CANCELLATION_LABELS = {
    "cancelled_by_customer_before_payment": "Отменён покупателем до оплаты",
    "cancelled_by_customer_after_payment": "Отменён покупателем после оплаты",
    "not_paid_in_time": "Не оплачен вовремя",
    "not_picked_up_in_time": "Не забрали вовремя",
}

PAYMENT_STATUS_LABELS = {
    "success": "Успешно",
    "failed": "Отказ",
    "refunded": "Возмещён",
}

PAYMENT_METHOD_LABELS = {
    "card": "Банковская карта",
    "sbp": "СБП",
    "mir_pay": "Mir Pay",
    "cash": "Наличные",
}

REASON_LABELS = {
    "CUSTOMER_ID_EMPTY": "Пустой ID покупателя",
    "CUSTOMER_ID_DUPLICATE_IN_LOAD": "Дубликат ID покупателя в загрузке",
    "CUSTOMER_ID_DUPLICATE_IN_HISTORY": "Дубликат ID покупателя в истории",
    "REGISTRATION_DATE_INVALID": "Некорректная дата регистрации",
    "ORDER_ID_EMPTY": "Пустой ID заказа",
    "ORDER_ID_DUPLICATE_IN_LOAD": "Дубликат ID заказа в загрузке",
    "CUSTOMER_NOT_FOUND": "Покупатель не найден",
    "CREATED_AT_INVALID": "Некорректная дата создания",
    "ORDER_AMOUNT_INVALID": "Некорректная сумма заказа",
    "ORDER_STATUS_INVALID": "Некорректный статус заказа",
    "CANCELLATION_REASON_INCONSISTENT": "Причина отмены не соответствует статусу",
    "REFUND_TIMELINE_INVALID": "Некорректные сроки возврата",
    "PAYMENT_ID_EMPTY": "Пустой ID платежа",
    "PAYMENT_ID_DUPLICATE_IN_LOAD": "Дубликат ID платежа в загрузке",
    "ORDER_NOT_FOUND": "Заказ не найден",
    "PAYMENT_DATE_INVALID": "Некорректная дата платежа",
    "PAYMENT_AMOUNT_INVALID": "Некорректная сумма платежа",
    "PAYMENT_STATUS_INVALID": "Некорректный статус платежа",
    "PAYMENT_BEFORE_ORDER": "Платёж раньше заказа",
}

# Weekday labels, Monday first; the number keeps them sortable as text.
WEEKDAY_LABELS = (
    "1 · Пн",
    "2 · Вт",
    "3 · Ср",
    "4 · Чт",
    "5 · Пт",
    "6 · Сб",
    "7 · Вс",
)

ENTITY_LABELS = {
    "customers": "Покупатели",
    "orders": "Заказы",
    "payments": "Платежи",
}

# Load order of the entities; the number keeps the legend in that order.
RANKED_ENTITY_LABELS = {
    "customers": "1 · Покупатели",
    "orders": "2 · Заказы",
    "payments": "3 · Платежи",
}

# (stage label, milestone column); the first stage counts every order.
FUNNEL_STAGES = (
    ("Создано", None),
    ("Оплачено", "paid_at"),
    ("Отправлено", "shipped_at"),
    ("Готово к выдаче", "ready_for_pickup_at"),
    ("Доставлено", "delivered_at"),
)

# (transition label, from, to)
STAGE_TRANSITIONS = (
    ("1. Оплата", "created_at", "paid_at"),
    ("2. Отправка", "paid_at", "shipped_at"),
    ("3. Доставка", "shipped_at", "ready_for_pickup_at"),
    ("4. Получение", "ready_for_pickup_at", "delivered_at"),
)

REFUND_AFTER_CANCELLATION = "Отмена"
REFUND_AFTER_RETURN = "Возврат товара"

WEEK_OFFSET_PREFIX = "нед. "
NEW_ORDER_LABEL = "Новый"
REPEAT_ORDER_LABEL = "Повторный"
CAPITAL_CITY = "Москва"

# --- thresholds ------------------------------------------------------------

REJECTED_SHARE_THRESHOLD = 0.05
HISTORY_LOOKBACK_DAYS = 365
REASON_SEPARATOR = " | "

# --- calendar --------------------------------------------------------------

# Public holidays as (month, day).
PUBLIC_HOLIDAYS = (
    (1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (1, 7), (1, 8),
    (2, 23),
    (3, 8),
    (5, 1),
    (5, 9),
    (6, 12),
    (11, 4),
)

PAYDAYS_OF_MONTH = (5, 20)
PROMO_DAY = (11, 11)

# --- stable buckets --------------------------------------------------------

BUCKETS = 10_000_000

# --- reconciliation --------------------------------------------------------

# Which rejection code answers for which kind of injected source defect.
DEFECT_CODES = {
    "customers.null_customer_id": "CUSTOMER_ID_EMPTY",
    "customers.duplicate_customer_id_rows": "CUSTOMER_ID_DUPLICATE_IN_LOAD",
    "customers.duplicate_customer_id_in_history": "CUSTOMER_ID_DUPLICATE_IN_HISTORY",
    "customers.invalid_registration_date": "REGISTRATION_DATE_INVALID",
    "orders.null_customer_id": "CUSTOMER_ID_EMPTY",
    "orders.negative_amount": "ORDER_AMOUNT_INVALID",
    "orders.invalid_status": "ORDER_STATUS_INVALID",
    "orders.duplicate_order_id_rows": "ORDER_ID_DUPLICATE_IN_LOAD",
    "orders.cancellation_reason_without_cancelled_status": "CANCELLATION_REASON_INCONSISTENT",
    "orders.refund_before_cancellation": "REFUND_TIMELINE_INVALID",
    "payments.missing_order_id": "ORDER_ID_EMPTY",
    "payments.negative_amount": "PAYMENT_AMOUNT_INVALID",
    "payments.invalid_status": "PAYMENT_STATUS_INVALID",
    "payments.payment_before_order": "PAYMENT_BEFORE_ORDER",
    "payments.duplicate_payment_id_rows": "PAYMENT_ID_DUPLICATE_IN_LOAD",
}

"""The raw entities: their envelope, columns, keys, required columns, quality rules and history columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _names(text: str) -> list[str]:
    return text.split()


def _typed(by_type: dict[str, str]) -> dict[str, str]:
    return {name: dtype for dtype, text in by_type.items() for name in text.split()}


def _rules(by_checks: dict[str, str]) -> dict[str, list[str]]:
    return {name: checks.split() for checks, text in by_checks.items() for name in text.split()}


@dataclass(frozen=True)
class Entity:
    """``kind`` is ``fact`` (append) or ``dim`` (versioned). Columns are text unless ``types`` says otherwise.

    An empty ``compare`` means that any non-key column starts a new version. Facts are partitioned by
    ``partition_date`` cut to ``partition_unit`` (``day``, ``month`` or ``year``).
    """

    name: str
    kind: str
    keys: list[str]
    required: list[str]
    columns: list[str]
    envelope: str = "d.results"
    types: dict[str, str] = field(default_factory=dict)
    rules: dict[str, list[str]] = field(default_factory=dict)
    compare: list[str] = field(default_factory=list)
    partition_date: str | None = None
    partition_unit: str = "day"
    # Of a keyed entity: the column that says which row of a key is newer.
    version: str | None = None

    @property
    def record_schema(self) -> T.StructType:
        ddl = ", ".join(f"`{c}` {self.types.get(c, 'string')}" for c in self.columns)
        return T.StructType.fromDDL(ddl)

    @property
    def document_schema(self) -> T.StructType:
        """Schema of one response document: the record array inside its envelope."""
        schema: T.DataType = T.ArrayType(self.record_schema)
        for part in reversed(self.envelope.split(".")):
            schema = T.StructType([T.StructField(part, schema)])
        return schema


# Names, types, keys and rules of the source system's entities (they must equal its interface).
ENTITIES: dict[str, Entity] = {
    "sales_order": Entity(
        name="sales_order",
        kind="fact",
        keys=_names("SalesOrder"),
        required=_names("SalesOrder"),
        partition_date="SalesOrderDate",
        columns=_names(
            """
            SalesOrder SalesOrderType SalesOrderTypeInternalCode SalesOrganization DistributionChannel
            OrganizationDivision SoldToParty CreationDate CreatedByUser LastChangeDate PurchaseOrderByCustomer
            PurchaseOrderByShipToParty SalesOrderDate TotalNetAmount TransactionCurrency PricingDate
            RequestedDeliveryDate ShippingCondition CompleteDeliveryIsDefined ShippingType
            IncotermsClassification IncotermsTransferLocation IncotermsLocation1 CustomerPaymentTerms
            ReferenceSDDocument ReferenceSDDocumentCategory CustomerAccountAssignmentGroup
            AccountingExchangeRate CustomerGroup SlsDocIsRlvtForProofOfDeliv OverallSDProcessStatus
            OverallTotalDeliveryStatus OverallSDDocumentRejectionSts BillingDocumentDate
            """
        ),
        types=_typed(
            {
                "boolean": "CompleteDeliveryIsDefined SlsDocIsRlvtForProofOfDeliv",
            }
        ),
        rules=_rules(
            {
                "odata_date": """
                    SalesOrderDate BillingDocumentDate CreationDate LastChangeDate
                    RequestedDeliveryDate PricingDate
                """,
                "numeric non_negative": "TotalNetAmount",
            }
        ),
    ),
    "sales_order_item": Entity(
        name="sales_order_item",
        kind="fact",
        keys=_names("SalesOrder SalesOrderItem"),
        required=_names("SalesOrder SalesOrderItem"),
        partition_date="BillingDocumentDate",
        columns=_names(
            """
            SalesOrder SalesOrderItem SalesOrderItemCategory SalesOrderItemText PurchaseOrderByCustomer
            PurchaseOrderByShipToParty Material RequestedQuantity RequestedQuantityUnit RequestedQuantitySAPUnit
            RequestedQuantityUnitISO OrderQuantityUnit OrderQuantityUnitISO OrderQuantityISOUnit
            ConfdDelivQtyInOrderQtyUnit ItemGrossWeight ItemNetWeight ItemWeightUnit ItemVolume
            TransactionCurrency NetAmount TotalSDDocReferenceStatus MaterialGroup ProductionPlant
            StorageLocation DeliveryGroup ShippingPoint ShippingType ProfitCenter ReferenceSDDocument
            DeliveryStatus SDProcessStatus BillingDocumentDate CustomerPaymentTerms CustomerGroup CostAmount
            TaxAmount Subtotal1Amount Subtotal2Amount Subtotal3Amount Subtotal4Amount Subtotal5Amount
            Subtotal6Amount YY1_Style_ID_SDI YY1_Engraving_SDI
            """
        ),
        rules=_rules(
            {
                "numeric non_negative": "RequestedQuantity ItemGrossWeight ItemNetWeight ItemVolume",
                "numeric": """
                    NetAmount CostAmount TaxAmount Subtotal1Amount Subtotal2Amount Subtotal3Amount
                    Subtotal4Amount Subtotal5Amount Subtotal6Amount
                """,
                "odata_date": "BillingDocumentDate",
            }
        ),
    ),
    "sales_order_partner": Entity(
        name="sales_order_partner",
        kind="dim",
        keys=_names("SalesOrder PartnerFunction PartnerFunctionInternalCode Customer"),
        required=_names("SalesOrder PartnerFunction PartnerFunctionInternalCode Customer"),
        columns=_names(
            """
            SalesOrder PartnerFunction PartnerFunctionInternalCode Customer Supplier Personnel ContactPerson
            WorkAssignmentExternalID ReferenceBusinessPartner AddressID VATRegistration
            """
        ),
        compare=_names(
            """
            Supplier Personnel ContactPerson WorkAssignmentExternalID ReferenceBusinessPartner AddressID
            VATRegistration
            """
        ),
    ),
    "sales_order_scheduleline": Entity(
        name="sales_order_scheduleline",
        kind="dim",
        keys=_names("SalesOrder SalesOrderItem ScheduleLine"),
        required=_names("SalesOrder SalesOrderItem ScheduleLine"),
        columns=_names(
            """
            SalesOrder SalesOrderItem ScheduleLine RequestedDeliveryDate ConfirmedDeliveryDate OrderQuantityUnit
            OrderQuantitySAPUnit OrderQuantityISOUnit ScheduleLineOrderQuantity ConfdOrderQtyByMatlAvailCheck
            DeliveredQtyInOrderQtyUnit OpenConfdDelivQtyInOrdQtyUnit CorrectedQtyInOrderQtyUnit
            DelivBlockReasonForSchedLine
            """
        ),
        rules=_rules(
            {
                "numeric non_negative": """
                    ScheduleLineOrderQuantity ConfdOrderQtyByMatlAvailCheck
                    DeliveredQtyInOrderQtyUnit OpenConfdDelivQtyInOrdQtyUnit
                    CorrectedQtyInOrderQtyUnit
                """,
                "odata_date": "RequestedDeliveryDate ConfirmedDeliveryDate",
            }
        ),
        compare=_names(
            """
            RequestedDeliveryDate ConfirmedDeliveryDate OrderQuantityUnit OrderQuantitySAPUnit
            OrderQuantityISOUnit ScheduleLineOrderQuantity ConfdOrderQtyByMatlAvailCheck
            DeliveredQtyInOrderQtyUnit OpenConfdDelivQtyInOrdQtyUnit CorrectedQtyInOrderQtyUnit
            DelivBlockReasonForSchedLine
            """
        ),
    ),
    "sales_order_pricing_element": Entity(
        name="sales_order_pricing_element",
        kind="dim",
        keys=_names("SalesOrder SalesOrderItem PricingProcedureStep PricingProcedureCounter"),
        required=_names("SalesOrder SalesOrderItem PricingProcedureStep PricingProcedureCounter"),
        columns=_names(
            """
            SalesOrder SalesOrderItem PricingProcedureStep PricingProcedureCounter ConditionType PricingDateTime
            PriceConditionDeterminationDte ConditionCalculationType ConditionBaseValue ConditionRateValue
            ConditionCurrency ConditionQuantity ConditionQuantityUnit ConditionQuantitySAPUnit
            ConditionQuantityISOUnit ConditionCategory ConditionIsForStatistics PricingScaleType
            IsRelevantForAccrual CndnIsRelevantForInvoiceList ConditionOrigin IsGroupCondition ConditionRecord
            ConditionSequentialNumber TaxCode WithholdingTaxCode CndnRoundingOffDiffAmount ConditionAmount
            TransactionCurrency ConditionControl ConditionInactiveReason ConditionClass
            PrcgProcedureCounterForHeader FactorForConditionBasisValue StructureCondition
            PeriodFactorForCndnBasisValue PricingScaleBasis ConditionScaleBasisValue ConditionScaleBasisUnit
            ConditionScaleBasisCurrency CndnIsRelevantForIntcoBilling ConditionIsManuallyChanged
            ConditionIsForConfiguration VariantCondition
            """
        ),
        types=_typed(
            {
                "boolean": """
                    ConditionIsForStatistics IsRelevantForAccrual CndnIsRelevantForIntcoBilling
                    ConditionIsManuallyChanged ConditionIsForConfiguration
                """,
            }
        ),
        rules=_rules(
            {
                "numeric": """
                    ConditionBaseValue ConditionRateValue ConditionAmount ConditionQuantity
                    CndnRoundingOffDiffAmount ConditionScaleBasisValue FactorForConditionBasisValue
                    PeriodFactorForCndnBasisValue PrcgProcedureCounterForHeader
                """,
                "odata_date": "PriceConditionDeterminationDte",
            }
        ),
        compare=_names(
            """
            ConditionType PricingDateTime ConditionCalculationType ConditionCurrency ConditionCategory
            ConditionIsForStatistics PricingScaleType IsRelevantForAccrual CndnIsRelevantForInvoiceList
            ConditionOrigin IsGroupCondition ConditionRecord ConditionSequentialNumber TaxCode
            WithholdingTaxCode CndnRoundingOffDiffAmount ConditionAmount TransactionCurrency ConditionControl
            ConditionInactiveReason ConditionClass PrcgProcedureCounterForHeader FactorForConditionBasisValue
            StructureCondition PeriodFactorForCndnBasisValue PricingScaleBasis ConditionScaleBasisValue
            ConditionScaleBasisUnit ConditionScaleBasisCurrency CndnIsRelevantForIntcoBilling
            ConditionIsManuallyChanged ConditionIsForConfiguration VariantCondition
            """
        ),
    ),
    "sales_order_subsequent_proc_flow": Entity(
        name="sales_order_subsequent_proc_flow",
        kind="dim",
        keys=_names("SalesOrder SalesOrderItem DocRelationshipUUID"),
        required=_names("SalesOrder SalesOrderItem DocRelationshipUUID"),
        columns=_names(
            """
            SalesOrder SalesOrderItem DocRelationshipUUID SubsequentDocument SubsequentDocumentItem
            SubsequentDocumentCategory ProcessFlowLevel RelatedProcFlowDocStsFieldName SDProcessStatus
            AccountingTransferStatus PrelimBillingDocumentStatus SubsqntDocItmPrecdgDocument
            SubsqntDocItmPrecdgDocItem SubsqntDocItmPrecdgDocCategory CreationDate CreationTime LastChangeDate
            """
        ),
        rules=_rules(
            {
                "numeric": "SubsequentDocumentItem ProcessFlowLevel SubsqntDocItmPrecdgDocItem",
                "odata_date": "CreationDate LastChangeDate",
            }
        ),
        compare=_names(
            """
            SubsequentDocument SubsequentDocumentItem SubsequentDocumentCategory ProcessFlowLevel
            RelatedProcFlowDocStsFieldName SDProcessStatus AccountingTransferStatus PrelimBillingDocumentStatus
            SubsqntDocItmPrecdgDocument SubsqntDocItmPrecdgDocItem SubsqntDocItmPrecdgDocCategory CreationDate
            CreationTime LastChangeDate
            """
        ),
    ),
    "outbound_delivery_header": Entity(
        name="outbound_delivery_header",
        kind="fact",
        keys=_names("DeliveryDocument"),
        required=_names("DeliveryDocument"),
        partition_date="CreationDate",
        columns=_names(
            """
            ActualDeliveryRoute Shippinglocationtimezone ActualGoodsMovementDate Receivinglocationtimezone
            ActualGoodsMovementTime BillingDocumentDate BillOfLading CompleteDeliveryIsDefined ConfirmationTime
            CreatedByUser CreationDate CreationTime CustomerGroup DeliveryBlockReason DeliveryDate
            DeliveryDocument DeliveryDocumentBySupplier DeliveryDocumentType DeliveryIsInPlant DeliveryPriority
            DeliveryTime DeliveryVersion DepreciationPercentage DistrStatusByDecentralizedWrhs DocumentDate
            ExternalIdentificationType ExternalTransportSystem FactoryCalendarByCustomer
            GoodsIssueOrReceiptSlipNumber GoodsIssueTime HandlingUnitInStock HdrGeneralIncompletionStatus
            HdrGoodsMvtIncompletionStatus HeaderBillgIncompletionStatus HeaderBillingBlockReason
            HeaderDelivIncompletionStatus HeaderGrossWeight HeaderNetWeight HeaderPackingIncompletionSts
            HeaderPickgIncompletionStatus HeaderVolume HeaderVolumeUnit HeaderWeightUnit IncotermsClassification
            IncotermsTransferLocation IntercompanyBillingDate InternalFinancialDocument
            IsDeliveryForSingleWarehouse IsExportDelivery LastChangeDate LastChangedByUser LoadingDate
            LoadingPoint LoadingTime MeansOfTransport MeansOfTransportRefMaterial MeansOfTransportType
            OrderCombinationIsAllowed OrderID OverallDelivConfStatus OverallDelivReltdBillgStatus
            OverallGoodsMovementStatus OverallIntcoBillingStatus OverallPackingStatus OverallPickingConfStatus
            OverallPickingStatus OverallProofOfDeliveryStatus OverallSDProcessStatus
            OverallWarehouseActivityStatus OvrlItmDelivIncompletionSts OvrlItmGdsMvtIncompletionSts
            OvrlItmGeneralIncompletionSts OvrlItmPackingIncompletionSts OvrlItmPickingIncompletionSts
            PaymentGuaranteeProcedure PickedItemsLocation PickingDate PickingTime PlannedGoodsIssueDate
            ProofOfDeliveryDate ProposedDeliveryRoute ReceivingPlant RouteSchedule SalesDistrict SalesOffice
            SalesOrganization SDDocumentCategory ShipmentBlockReason ShippingCondition ShippingPoint
            ShippingType ShipToParty SoldToParty SpecialProcessingCode StatisticsCurrency Supplier
            TotalBlockStatus TotalCreditCheckStatus TotalNumberOfPackage TransactionCurrency TransportationGroup
            TransportationPlanningDate TransportationPlanningStatus TransportationPlanningTime
            UnloadingPointName Warehouse WarehouseGate WarehouseStagingArea
            """
        ),
        types=_typed(
            {
                "boolean": "CompleteDeliveryIsDefined DeliveryIsInPlant OrderCombinationIsAllowed",
            }
        ),
        rules=_rules(
            {
                "odata_date": """
                    ActualGoodsMovementDate BillingDocumentDate CreationDate DeliveryDate
                    DocumentDate IntercompanyBillingDate LastChangeDate LoadingDate PickingDate
                    PlannedGoodsIssueDate ProofOfDeliveryDate TransportationPlanningDate
                """,
            }
        ),
    ),
    "outbound_delivery_item": Entity(
        name="outbound_delivery_item",
        kind="fact",
        keys=_names("DeliveryDocument DeliveryDocumentItem"),
        required=_names("DeliveryDocument DeliveryDocumentItem"),
        partition_date="CreationDate",
        columns=_names(
            """
            ActualDeliveredQtyInBaseUnit ActualDeliveryQuantity BaseUnit ControllingArea CreatedByUser
            CreationDate CreationTime DeliveryDocument DeliveryDocumentItem DeliveryDocumentItemCategory
            DeliveryDocumentItemText DeliveryGroup DeliveryQuantityUnit DeliveryRelatedBillingStatus
            DeliveryToBaseQuantityDnmntr DeliveryToBaseQuantityNmrtr DeliveryVersion DistributionChannel
            Division GoodsMovementReasonCode GoodsMovementStatus GoodsMovementType IsCompletelyDelivered
            ItemBillingIncompletionStatus ItemDeliveryIncompletionStatus ItemGdsMvtIncompletionSts
            ItemGeneralIncompletionStatus ItemGrossWeight ItemIsBillingRelevant ItemNetWeight
            ItemPackingIncompletionStatus ItemPickingIncompletionStatus ItemVolume ItemVolumeUnit ItemWeightUnit
            LoadingGroup Material MaterialGroup MaterialIsBatchManaged MaterialIsIntBatchManaged
            NumberOfSerialNumbers OriginalDeliveryQuantity OriginallyRequestedMaterial
            OverdelivTolrtdLmtRatioInPct PickingControl PickingStatus Plant ProductAvailabilityDate
            ProductAvailabilityTime ProductConfiguration ProfitabilitySegment ProfitCenter QuantityIsFixed
            ReferenceSDDocument ReferenceSDDocumentCategory ReferenceSDDocumentItem SDDocumentCategory
            SDProcessStatus StorageLocation TransportationGroup UnderdelivTolrtdLmtRatioInPct
            UnlimitedOverdeliveryIsAllowed
            """
        ),
        types=_typed(
            {
                "boolean": """
                    IsCompletelyDelivered MaterialIsBatchManaged MaterialIsIntBatchManaged
                    QuantityIsFixed UnlimitedOverdeliveryIsAllowed
                """,
            }
        ),
        rules=_rules(
            {
                "odata_date": "CreationDate ProductAvailabilityDate",
                "numeric": """
                    ActualDeliveredQtyInBaseUnit ActualDeliveryQuantity ItemGrossWeight
                    ItemNetWeight OriginalDeliveryQuantity
                """,
            }
        ),
    ),
    "outbound_delivery_partner": Entity(
        name="outbound_delivery_partner",
        kind="dim",
        keys=_names("SDDocument PartnerFunction"),
        required=_names("SDDocument PartnerFunction"),
        columns=_names(
            """
            SDDocument SDDocumentItem PartnerFunction Customer Supplier ContactPerson Personnel AddressID
            BusinessPartnerAddressUUID RefBusinessPartnerAddressUUID
            """
        ),
    ),
    "outbound_delivery_address": Entity(
        name="outbound_delivery_address",
        kind="dim",
        keys=_names("DeliveryDocument PartnerFunction"),
        required=_names("DeliveryDocument PartnerFunction AddressID"),
        columns=_names(
            """
            DeliveryDocument PartnerFunction DeliveryVersion AddressID AdditionalStreetPrefixName
            AdditionalStreetSuffixName AddressTimeZone Building BusinessPartnerName1 BusinessPartnerName2
            BusinessPartnerName3 BusinessPartnerName4 PersonFamilyName PersonGivenName CareOfName CityName
            CompanyPostalCode CorrespondenceLanguage Country County DeliveryServiceNumber
            DeliveryServiceTypeCode District EmailAddress FaxNumber FaxNumberExtension Floor FormOfAddress
            HomeCityName HouseNumber HouseNumberSupplementText MobilePhoneNumber PhoneNumber
            PhoneNumberExtension POBox POBoxDeviatingCityName POBoxDeviatingCountry POBoxDeviatingRegion
            POBoxIsWithoutNumber POBoxLobbyName POBoxPostalCode PostalCode PrfrdCommMediumType Region RoomNumber
            StreetName StreetPrefixName StreetSuffixName TaxJurisdiction TransportZone
            """
        ),
        types=_typed(
            {
                "boolean": "POBoxIsWithoutNumber",
            }
        ),
    ),
    "warehouse_order": Entity(
        name="warehouse_order",
        kind="fact",
        envelope="value",
        keys=_names("EWMWarehouse WarehouseOrder"),
        required=_names("EWMWarehouse WarehouseOrder"),
        partition_date="WhseOrderCreationDateTime",
        columns=_names(
            """
            EWMWarehouse WarehouseOrder WarehouseOrderStatus WhseOrderCreationDateTime
            WarehouseOrderStartDateTime WhseOrderConfirmedDateTime WhseOrderLastChgUTCDateTime
            WhseOrderLatestStartDateTime WarehouseOrderCreationRule WhseOrderCreationRuleCategory ActivityArea
            Queue Processor ExecutingResource WhseProcessTypeDocumentHdr CreatedByUser LastChangedByUser
            ConfirmedByUser WhseOrderForSplitWhseOrder WarehouseOrderIsSplit WarehouseOrderPlannedDuration
            WhseOrderPlanDurationTimeUnit
            """
        ),
        types=_typed(
            {
                "boolean": "WarehouseOrderIsSplit",
                "decimal(15,3)": "WarehouseOrderPlannedDuration",
            }
        ),
        rules=_rules(
            {
                "iso_date": """
                    WhseOrderCreationDateTime WarehouseOrderStartDateTime WhseOrderConfirmedDateTime
                    WhseOrderLastChgUTCDateTime WhseOrderLatestStartDateTime
                """,
            }
        ),
    ),
    "warehouse_task": Entity(
        name="warehouse_task",
        kind="fact",
        envelope="value",
        keys=_names("EWMWarehouse WarehouseTask"),
        required=_names("EWMWarehouse WarehouseTask"),
        partition_date="WhseTaskCrtnUTCDateTime",
        columns=_names(
            """
            EWMWarehouse WarehouseTask WarehouseTaskItem WarehouseOrder WhseTaskCrtnUTCDateTime
            WhseTaskLastChgUTCDateTime WhseTaskConfUTCDateTime ConfirmedByUser WhseTaskPlannedClosingDateTime
            WhseTaskGoodsReceiptDateTime WarehouseTaskStatus WarehouseProcessType WarehouseProcessCategory
            IsHandlingUnitWarehouseTask EWMHandlingUnitType HandlingUnitTypeGroup HomogeneousFullPalletPick
            EWMPutAwayPhysInvtryPlnSts EWMWhseTskLowStkChkPlnSts EWMPutAwayPhysInvtryExecSts
            EWMWhseTskLowStkChkExecSts Product Batch BatchChangeIsNotAllowed CountryOfOrigin
            ShelfLifeExpirationDate EWMStockType EWMStockUsage EWMStockOwner EntitledToDisposeParty
            WBSElementInternalID WBSElementExternalID SpecialStockIdfgSalesOrder SpecialStockIdfgSalesOrderItem
            ExecutingResource WarehouseMovementsReason ProductionOrder EWMProductionSupplyArea
            EWMDocumentCategory EWMReferenceDocumentCategory EWMDelivery EWMDeliveryItem PurchasingDocument
            PurchasingDocumentItem SalesDocument SalesDocumentItem BaseUnit EWMBaseUnitISOCode AlternativeUnit
            EWMAlternativeUnitISOCode TargetQuantityInBaseUnit TargetQuantityInAltvUnit ActualQuantityInBaseUnit
            ActualQuantityInAltvUnit DifferenceQuantityInBaseUnit DifferenceQuantityInAltvUnit
            WhseTaskNetWeightUnitOfMeasure WhseTaskNetWeight WhseTaskNetVolumeUnitOfMeasure WhseTaskNetVolume
            SourceStorageType SourceStorageSection SourceStorageBin SourceResource DestinationStorageType
            DestinationStorageSection DestinationStorageBin DestinationResource WhseTaskTwoStepPickingType
            WhseTaskTwoStepPickingRlvnce ActivityArea SourceHandlingUnit DestinationHandlingUnit
            WarehouseTaskExceptionCode WhseTaskSortingSequenceValue WarehouseOrderSequenceValue
            WarehouseOrderActivityArea WarehouseOrderCreationRule WarehouseOrderQueue WarehouseActivityType
            EWMConsolidationGroup EWMWarehouseTaskPriority CreatedByUser EWMRoute EWMCanceledWarehouseTask
            SerialNumberRequiredLevel
            """
        ),
        types=_typed(
            {
                "boolean": "IsHandlingUnitWarehouseTask BatchChangeIsNotAllowed",
                "decimal(18,3)": """
                    TargetQuantityInBaseUnit TargetQuantityInAltvUnit ActualQuantityInBaseUnit
                    ActualQuantityInAltvUnit DifferenceQuantityInBaseUnit
                    DifferenceQuantityInAltvUnit
                """,
                "decimal(15,3)": "WhseTaskNetWeight WhseTaskNetVolume",
                "decimal(10,0)": "WhseTaskSortingSequenceValue",
                "int": "EWMWarehouseTaskPriority",
            }
        ),
        rules=_rules(
            {
                "iso_date": """
                    WhseTaskCrtnUTCDateTime WhseTaskLastChgUTCDateTime WhseTaskConfUTCDateTime
                    WhseTaskPlannedClosingDateTime WhseTaskGoodsReceiptDateTime
                    ShelfLifeExpirationDate
                """,
            }
        ),
    ),
}
